import random

import numpy as np
import pyarrow as pa
import pytest
from test_decontaminate import words

from siltworks.llm import neardup as N
from siltworks.llm import textbytes as tb
from siltworks.llm.workspace import Tables


def shingle_set(t):
    w = words(t)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    """Classes by all pairs, with the smallest id of each."""
    sets = {k: shingle_set(t) for k, t in docs}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            s, t = sets[a], sets[b]
            if s and t and len(s & t) >= 0.8 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def corpus(seed, groups=12, size=9):
    """Groups of copies changed by more and more words, so that many pairs lie near the threshold."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    docs = []
    for g in range(groups):
        base = rng.choices(vocab, k=rng.choice([4, 30, 120]))
        for _ in range(size):
            t = list(base)
            for _ in range(rng.randrange(5)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            docs.append(" ".join(t))
    docs += ["", "", None, "...", "...", "one", "one", "One!", "one two"]
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_against_all_pairs(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, k int")
    got = {r.doc_id: (r.class_id, r.class_size) for r in N.classes(df).collect()}
    want = brute(docs)
    assert {k: c for k, (c, _) in got.items()} == want
    assert all(n == sum(c == d for d in want.values()) for c, n in got.values())
    kept = N.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_copies_that_repeat_a_line_are_found(spark):
    rng = random.Random(5)
    docs = []
    for times in (20, 100, 1000) * 10:
        # Set similarity 0.96 and 0.805.
        for changed in ((), (3, 50)):
            base = [f"w{rng.randrange(10**6)}" for _ in range(104)]
            copy = base[:-20] + base[-20:] * times
            for i in changed:
                copy[i] = "new"
            docs += [" ".join(base), " ".join(copy)]
    docs = list(enumerate(docs))
    want = brute(docs)
    assert len(set(want.values())) == len(docs) // 2
    got = N.classes(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in got.collect()} == want


def test_prefix_filter_leaves_out_no_pair(spark):
    docs = [(k, t) for k, t in corpus(7, groups=6) if t and words(t)]
    texts = spark.createDataFrame(docs, "k long, t string")
    rest = spark.createDataFrame([(k, k) for k, _ in docs], "k long, c long")
    pairs = {(r.a, r.b) for r in N._prefix_pairs(rest, texts, 0.8, 5).collect()}
    sets = {k: shingle_set(t) for k, t in docs}
    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                assert (a, b) in pairs


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    h = rng.integers(1, 2**63, 300).astype(np.uint64)
    w1, w2 = rng.uniform(0.5, 4, 300), rng.uniform(0.5, 4, 300)
    w2[200:] = 0
    rows = np.repeat([0, 1], [300, 200])
    sig = N.probminhash(np.concatenate([h, h[:200]]), rows, np.concatenate([w1, w2[:200]]), 2, 4000)
    x, y = w1[:200], w2[:200]
    want = sum(1 / np.maximum(w1 / a, w2 / b).sum() for a, b in zip(x, y))
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03
    alone = N.probminhash(h, np.zeros(300, int), w1, 1, 4000)
    assert (alone[0] == sig[0]).all()


def test_long_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r.k: r.c for r in N.components(edges, Tables(spark, "chain"), "c").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}
    parents = edges.filter("a < 50").selectExpr("b as k", "a as p")
    tables = Tables(spark, "forest")
    assert {r.k: r.c for r in N.forest_roots(parents, tables).collect()} == {i: 0 for i in range(1, 41)}
    assert len(tables.names) == 1
    assert N.components(edges.filter("a > 1000"), Tables(spark, "none"), "c").isEmpty()


def test_repeated_rows_null_ids_and_empty_tables(spark):
    kind = "doc_id long, text string"
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "x y"), (None, None)], kind)
    assert sorted((r.doc_id or 0) for r in N.drop_near_duplicates(df).collect()) == [0, 0, 1]
    assert N.classes(df).count() == 5
    assert N.classes(spark.createDataFrame([], kind)).count() == 0
    assert N.drop_near_duplicates(spark.createDataFrame([], kind)).count() == 0


def test_an_id_with_several_texts_has_a_class_for_each(spark):
    copy, own = "one two three four five six seven", "alpha beta gamma delta epsilon zeta eta"
    df = spark.createDataFrame([(1, copy), (2, copy), (2, own), (2, own), (3, own + " x"), (4, "")], "doc_id long, text string")
    got = {(r.doc_id, r.text) for r in N.drop_near_duplicates(df).collect()}
    assert got == {(1, copy), (2, own), (3, own + " x"), (4, "")}
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in N.classes(df).collect()) == [(1, 1, 2), (2, 1, 2), (2, 2, 2), (2, 2, 2), (3, 3, 1), (4, 4, 1)]


def test_text_ids_and_clashing_columns(spark):
    t = "a b c d e f g h"
    df = spark.createDataFrame([("x", t, 1, 2, 3), ("w", t, 4, 5, 6), (None, t, 7, 8, 9)], "k string, t string, x1 int, id int, row int")
    assert sorted((r.k or "", r.class_id, r.class_size) for r in N.classes(df, id_col="k", text_col="t").collect()) == [("", "w", 2), ("w", "w", 2), ("x", "w", 2)]
    kept = N.drop_near_duplicates(df, id_col="k", text_col="t")
    assert kept.columns == df.columns and {r.x1 for r in kept.collect()} == {4, 7}


def test_links_are_counted(spark):
    base = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(base[:-1] + [f"end{i}"])) for i in range(6)] + [(9, "quite another text of seven words")]
    got = {r.doc_id: (r.class_id, r.class_size, r.n_links) for r in N.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[9] == (9, 1, 0) and all(got[i][:2] == (0, 6) and got[i][2] >= 5 for i in range(6))


def test_a_very_long_text_meets_its_copy(spark):
    rng = random.Random(3)
    long = [f"w{rng.randrange(10**5)}" for _ in range(300_000)]
    docs = [(1, " ".join(long)), (2, " ".join(long[:-500])), (3, "short text of a few words here")]
    got = {r.doc_id: r.class_id for r in N.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_short_texts_are_one_shingle():
    data, offsets = tb.flat(pa.array(["a b", "a  B", "b a", "a b c d e", "a b c d e f"]))
    h, r = N.shingles(data, offsets)
    by = {i: set(h[r == i].tolist()) for i in range(5)}
    assert by[0] == by[1] != by[2] and len(by[3]) == 1 and len(by[4]) == 2 and by[3] < by[4]
