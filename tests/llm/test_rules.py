"""Quality rules: counts against plain Python, the fit, calibration and edge cases."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltworks.llm import qualityrules as qr
from siltworks.llm import textbytes as tb

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\r\x0b\x1c é#*日|", max_size=40)), min_size=1, max_size=6))
def test_counts_agree_with_plain_python(texts):
    data, offsets = tb.flat(pa.array(texts, pa.string()))
    assert qr.base_counts(data, offsets, qr.words_of(data, offsets)).tolist() == [plain(t) for t in texts]


def test_long_lines_that_swap_far_bytes_differ():
    a = "a" + "x" * 4095 + "b" + "y" * 9000
    b = "b" + "x" * 4095 + "a" + "y" * 9000
    data, offsets = tb.flat(pa.array([a + "\n" + b + "\n" + a, a]))
    assert qr.base_counts(data, offsets, qr.words_of(data, offsets))[:, 3].tolist() == [1, 0]


def test_base_rule_at_its_limits():
    counts = np.array([[50, 1, 0, 0, 25], [50, 1, 0, 0, 26], [49, 1, 0, 0, 0], [0, 0, 0, 0, 0]])
    assert qr.failed(counts).tolist() == [False, True, True, True]


def test_platt_line_finds_slope_and_offset():
    rng = np.random.default_rng(5)
    score = rng.normal(0, 3, 40_000)
    y = (rng.random(40_000) < qr.sigmoid(0.7 * score - 0.4)).astype(float)
    slope, offset = qr.line(score, y)
    assert abs(slope - 0.7) < 0.03 and abs(offset + 0.4) < 0.05


def test_training_agrees_with_dense_gradient_steps():
    rng = np.random.default_rng(2)
    dense = np.where(rng.random((12, 6)) < 0.5, rng.random((12, 6)), 0).astype(np.float32)
    y = (rng.random(12) < 0.5).astype(float)
    row, x = np.nonzero(dense)
    got, bias = qr.train(row, x.astype(np.int32), dense[row, x], y)
    w, m, v = np.zeros(7), np.zeros(7), np.zeros(7)
    full = np.concatenate([dense, np.ones((12, 1))], axis=1)
    for t in range(1, qr.STEPS + 1):
        grad = full.T @ (y - qr.sigmoid(full @ w)) / 12 - qr.L2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w + qr.RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    assert np.allclose(got[:6], w[:6], atol=1e-6) and abs(bias - w[6]) < 1e-6


def sample(n):
    rng = np.random.default_rng(1)
    good, bad = ["river", "stone", "walks", "over", "green", "hills", "and", "sings"], ["BUY", "$$$", "click", "now", "WIN", "||", "free", "###"]
    return [(i, " ".join(rng.choice(good if i % 3 else bad, 80)) + f" {i}", int(i % 3 > 0)) for i in range(n)]


def test_fit_tells_kinds_apart_and_keeps_columns(spark):
    rows = sample(300)
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t, _ in rows] + [(900, None, None, 1), (901, "", None, 2), (902, "w " * 200_000, None, 3), (5, rows[5][1], "x", 7), (None, rows[4][1], "z", 8)], "doc_id int, text string, _id string, kept int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, 1), (4, None), (None, 0)], "doc_id int, quality int")
    model = qr.fit(docs, labels)
    got = qr.judge(docs, model).collect()
    assert len(got) == docs.count()
    held = [i for i, _, _ in rows if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    by = {r.doc_id: r for r in got}
    assert all((by[i].score >= qr.THRESHOLD) == (i % 3 > 0) for i in held)
    assert all(by[i].base_failed and not by[i].kept for i in (900, 901, 902))
    assert by[902].n_repeat_words == 200_000 and 0 <= by[901].score <= 1
    stays = qr.keep_good(docs, model)
    assert stays.columns == docs.columns and stays.count() == sum(r.kept for r in got)
    assert stays.filter(F.col("doc_id") == 5).count() == 2 * by[5].kept


def test_fit_without_labels_or_of_one_kind(spark):
    docs = spark.createDataFrame([(i, "word " * 3) for i in range(20)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert qr.judge(docs, qr.fit(docs, none)).agg(F.min("score")).first()[0] > 0.999
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id bigint, quality int")
    scores = {r.score for r in qr.judge(docs, qr.fit(docs, ones)).collect()}
    assert len(scores) == 1 and scores.pop() > 0.9
    assert qr.judge(docs.limit(0), qr.fit(docs.limit(0), ones)).count() == 0


def test_query_over_its_table(spark):
    got = qr.op13_quality_rules(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(got) == len(texts)
    assert all([r[c] for c in qr.COUNTS] == plain(texts[r.doc_id]) for r in got)
    assert not any(r.base_failed and r.kept for r in got)
