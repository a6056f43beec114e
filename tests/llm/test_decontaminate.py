import hashlib
import random
import re

import numpy as np
from conftest import SMALL, table
from pyspark.sql import functions as F

from siltworks.llm import decontaminate as D
from siltworks.llm import textbytes as tb

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text, items, window=13):
    w = words(text)
    hit, names = set(), set()
    for k, t in items:
        v = words(t)
        n = min(len(v), window)
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                names.add(str(k))
    return len(w), len(hit), sorted(names)


def test_against_brute_force(spark):
    rng = random.Random(1)
    vocab = ["A", "b", "É", "d1", "e"]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    items = [(i, text(rng.choice([0, 1, 2, 5, 12, 13, 14, 30]))) for i in range(12)] + [(3, "b, b! b"), (50, None), (51, "A É")]
    docs = [(i, text(rng.choice([0, 1, 5, 40, 200])) + rng.choice(["", "\n" + (items[rng.randrange(12)][1] or "")])) for i in range(60)] + [(100, None), (101, ""), (7, "A É"), (7, "A É")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_hit", F.lit("clash")).withColumn("_id", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in D.match(d, b).collect())
    assert got == sorted((k, *brute(t, items)) for k, t in docs)


def test_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(2)
    items = [(i, " ".join(rng.choices("abcdefgh", k=20))) for i in range(9)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices("abcdefgh", k=60)) + " " + items[i][1]) for i in range(9)], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(str, D.match(docs, b).collect()))
    monkeypatch.setattr(D, "BLOCK_WORDS", 45)
    assert sorted(map(str, D.match(docs, b).collect())) == whole


def test_spans_and_removal(spark):
    item = " ".join(f"w{i}" for i in range(20))
    text = "é begin " + item.upper() + ", end " + "x " * 500
    docs = spark.createDataFrame([(1, text, 9), (2, item, 9), (3, None, 9), (4, "", 9)], "doc_id long, text string, row int")
    b = spark.createDataFrame([(5, item)], "item_id long, text string")
    m = {r.doc_id: r for r in D.match(docs, b).collect()}
    assert m[1].longest == 20 and [(s.start, s.end) for s in m[1].spans] == [(2, 22)]
    s = m[1].spans_bytes[0]
    assert text.encode()[s.start : s.end].decode() == item.upper()
    kept = {r.doc_id: r for r in D.decontaminate(docs, b).collect()}
    assert set(kept) == {1, 3, 4} and kept[1].text == text and kept[1].row == 9
    cut = {r.doc_id: r.text for r in D.decontaminate(docs, b, max_span=15).collect()}
    assert cut[1] == text.replace(item.upper(), "") and cut[3] is None
    both = item + " \U0001f600 " + "y " * 900 + item
    odd = spark.createDataFrame([(1, both), (2, "é" + item + "x " * 900)], "doc_id long, text string")
    cut = {r.doc_id: r.text for r in D.decontaminate(odd, b, max_span=12).collect()}
    # "éw0" and "w19x" are other words.
    assert cut[1] == " \U0001f600 " + "y " * 900 and cut[2] == "éw0  w19" + "x " * 900


def test_a_very_long_text_and_a_large_benchmark(spark):
    rng = random.Random(3)
    items = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))) for i in range(200)]
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200_000))
    docs = spark.createDataFrame([(1, long + " " + items[7][1]), (2, items[150][1])], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in D.match(docs, spark.createDataFrame(items, "item_id long, text string"), block_words=2000).collect()}
    assert got == {1: (40, ["7"]), 2: (40, ["150"])}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert D.match(none, b).count() == 0
    r = D.match(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), b).first()
    assert (r.n_words, r.n_hit, r.n_items) == (2, 0, 0)


def test_query_against_sql(spark, oracle):
    assert table(D.op2_decontaminate(spark, SMALL).toPandas()) == oracle(D.OP2_SQL)
    assert D._EMPTY == hashlib.sha256(b"").hexdigest()


def test_word_hashes_tell_words_apart():
    h = tb.word_hashes(["Ab ab AB aB1 é É", None, "x" * 9000 + " " + "x" * 9001])
    assert len(set(h[0][:3].tolist())) == 1 and len(np.unique(h[0])) == 4 and len(h[1]) == 0 and h[2][0] != h[2][1]
