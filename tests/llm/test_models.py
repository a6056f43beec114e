"""Held-out accuracy and edge cases of the learnt operators."""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltworks.llm import langid, quality, toxicity

KIND = "doc_id long, text string, score string, row int"


def held(k, m):
    return zlib.crc32(str(k).encode()) % m


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(3)
    vocab = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(600):
        w = list(rng.choice(vocab, 60))
        toxic = i % 4 == 0
        if toxic:
            w[rng.integers(60)] = "Nastyword"
        bad = i % 3 == 0
        lines = [" ".join(w[j : j + 12]) for j in range(0, 60, 12)]
        if bad:
            lines[1:] = [x.upper().replace(" ", "!! ") for x in lines[1:]]
        rows.append((i, "\n".join(lines), int(not bad), int(toxic)))
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t, _, _ in rows], KIND)
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows] + [(1, None, None), (None, 1, 1), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    return docs, labels, {i: (q, x) for i, _, q, x in rows}


def test_toxicity_held_out(spark, corpus):
    docs, labels, truth = corpus
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    out = [k for k in truth if held(k, 5) == 0]
    assert np.mean([(got[k] >= 0.5) == (truth[k][1] == 1) for k in out]) > 0.97
    assert len(model.index) < 5000
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k in truth if got[k] < 0.5}
    # Labels of held-out rows are not looked at.
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(docs, flipped)
    assert (again.index == model.index).all() and np.allclose(again.weight, model.weight)


def test_toxicity_edges(spark, corpus):
    docs, labels, _ = corpus
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(1, None, "a", 1), (1, None, "a", 1), (None, "", "a", 1), (3, "nastyword " * 30000, "a", 1)], KIND)
    got = sorted((r.score for r in toxicity.score(odd, model).collect()))
    assert len(got) == 4 and got[0] == got[2] < 0.5 < got[3]
    none = toxicity.fit(docs.limit(0), labels.limit(0))
    assert toxicity.score(docs, none).filter("score > 0.001").count() == 0 and toxicity.score(docs.limit(0), none).count() == 0


def test_features_are_whole_words():
    from siltworks.llm import textbytes as tb

    kinds = [set(x.tolist()) for x, _ in toxicity.features(*tb.flat(pa.array(["one two three"])))]
    assert [len(k) for k in kinds] == [3, 1, 2, 1]


def test_quality_held_out(spark, corpus):
    docs, labels, truth = corpus
    model = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    out = [k for k in truth if held(k, 5) == 0]
    assert np.mean([(got[k].score >= quality.THRESHOLD) == (truth[k][0] == 1) for k in out]) > 0.97
    assert got[1].n_lines == 5
    odd = spark.createDataFrame([(1, None, "a", 1), (2, "", "a", 1), (3, "\n\n", "a", 1), (4, "x" * 300000, "a", 1)], KIND)
    rows = {r.doc_id: r for r in quality.score(odd, model).collect()}
    assert rows[1].score == rows[2].score and rows[3].n_lines == 3 and all(0 <= r.score <= 1 for r in rows.values())
    assert quality.fit(docs.limit(0), labels.limit(0)) is None and quality.score(docs, None).filter("score < 1").count() == 0
    assert quality.score(docs.limit(0), model).count() == 0


def test_forward_backward_against_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    bounds = np.array([0, 3, 4, 8])
    emit, trans = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    marginal, pair, log_z = quality.forward_backward(emit, trans, bounds)
    total = np.zeros((2, 2))
    for c in range(3):
        a, b = bounds[c], bounds[c + 1]
        want, z = np.zeros((b - a, 2)), 0.0
        for y in itertools.product((0, 1), repeat=b - a):
            p = np.exp(sum(emit[a + i, v] for i, v in enumerate(y)) + sum(trans[u, v] for u, v in zip(y, y[1:])))
            z += p
            for i, v in enumerate(y):
                want[i, v] += p
        for y in itertools.product((0, 1), repeat=b - a):
            p = np.exp(sum(emit[a + i, v] for i, v in enumerate(y)) + sum(trans[u, v] for u, v in zip(y, y[1:]))) / z
            for u, v in zip(y, y[1:]):
                total[u, v] += p
        assert np.allclose(marginal[a:b], want / z) and np.isclose(log_z[c], np.log(z))
    assert np.allclose(pair, total)


def test_language_mixtures(spark):
    rng = np.random.default_rng(1)
    syll = {"aa": ["ka", "lo", "mi"], "bb": ["zr", "qu", "xe"], "cc": ["ño", "éb", "üt"]}
    word = lambda k: "".join(rng.choice(syll[k], 3))
    rows = [(i, " ".join(word(k) for _ in range(40)), k) for i, k in enumerate(list(syll) * 60)]
    docs = spark.createDataFrame(rows + [(1000, "zzz", None), (None, "kalo", "aa")], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model[0] == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert np.mean([got[i].lang_pred == k for i, _, k in rows if held(i, 4) == 2]) > 0.98
    mixed = " ".join([word("aa") for _ in range(60)] + [word("bb") for _ in range(30)])
    odd = spark.createDataFrame([(1, mixed), (2, None), (3, "123 ### …"), (4, ""), (5, "—— 12"), (6, "é")], "doc_id long, text string")
    r = {x.doc_id: x for x in langid.predict(odd, model).collect()}
    assert r[1].lang_pred == "aa" and set(r[1].mixture) == {"aa", "bb"} and abs(r[1].score - 2 / 3) < 0.1
    assert all((r[i].lang_pred, r[i].score) == ("und", 0.0) for i in (2, 3, 4, 5)) and r[6].lang_pred != "und"
    nothing = langid.fit(docs.limit(0))
    assert {x.lang_pred for x in langid.predict(odd, nothing).collect()} == {"und"} and langid.predict(odd.limit(0), model).count() == 0


def test_learning_ignores_held_out_languages(spark):
    docs = spark.createDataFrame([(i, "abc def", "xx" if held(i, 4) == 2 else "yy") for i in range(40)], "doc_id long, text string, lang string")
    assert langid.fit(docs)[0] == ["yy"]


def test_counts_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame(pd.DataFrame({"doc_id": range(50), "text": ["abc déf " * i for i in range(50)], "lang": ["a", "b"] * 25}))
    one, many = langid.fit(docs.repartition(1)), langid.fit(docs.repartition(7))
    assert one[0] == many[0] and np.array_equal(one[1], many[1])


def test_ftrl_against_plain_python():
    docs = [np.array(x, np.int32) for x in ([1, 2], [2, 3], [1], [4, 2, 7], [3, 7])]
    labels = np.array([1.0, 0, 1, 0, 1])
    alpha, beta, l1, l2 = 0.5, 1.0, 0.05, 0.1
    w, bias = toxicity.ftrl(docs, labels, alpha=alpha, beta=beta, l1=l1, l2=l2, epochs=3, seed=11)
    z, n, zb, nb = {}, {}, 0.0, 0.0

    def weight(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - np.sign(zi) * l1) / ((beta + ni**0.5) / alpha + l2)

    order = np.random.Generator(np.random.PCG64(11))
    for _ in range(3):
        for k in order.permutation(5):
            own = {int(i): weight(int(i)) for i in docs[k]}
            b = -zb / ((beta + nb**0.5) / alpha)
            g = 1 / (1 + np.exp(-(sum(own.values()) + b))) - labels[k]
            for i, v in own.items():
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / alpha * v
                n[i] = old + g * g
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / alpha * b
            nb += g * g
    assert np.allclose([w[i] for i in range(9)], [weight(i) for i in range(9)]) and np.isclose(bias, b)


def test_mixture_against_plain_python():
    rng = np.random.default_rng(8)
    log_p = np.log(rng.dirichlet(np.full(1 << langid.BITS, 0.02), 6).T + 1e-6).astype(np.float32)
    texts = ["".join(rng.choice(list("abcdefgh "), 60)) for _ in range(8)]
    for text in texts:
        data, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
        got = langid.mixture(log_p, data, offsets, penalty=0.2)[0]
        gram, first, _ = langid.trigrams(data, offsets)
        words = np.split(gram, first[1:])
        like = np.array([np.exp(np.maximum((s := log_p[w].sum(axis=0)) - s.max(), -60)) for w in words], float)

        def em(pi, rounds):
            for _ in range(rounds):
                part = like * pi
                pi = (part / part.sum(axis=1, keepdims=True)).mean(axis=0)
            return pi, np.log((like * pi).sum(axis=1)).sum()

        full, _ = em(np.full(6, 1 / 6), langid.ROUNDS)
        rank, best = np.argsort(-full, kind="stable"), None
        for k in range(1, 7):
            pi = np.zeros(6)
            pi[rank[:k]] = full[rank[:k]]
            pi, value = em(pi / pi.sum(), 0 if k == 1 else 3)
            value -= 0.2 * k * np.log(len(words) + 1)
            if best is None or value > best[1] + 1e-9:
                best = pi, value
        assert np.allclose(got, best[0], atol=2e-3)


def test_an_id_repeated_very_often_is_learnt_once(spark, corpus):
    docs, labels, _ = corpus
    many = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("other text "), F.col("id").cast("string")).alias("text"), F.lit("x").alias("score"), F.lit(1).alias("row"))
    assert len(toxicity.fit(docs.union(many), labels).index) < 5000
    model = quality.fit(docs.union(many), labels)
    again = quality.fit(docs, labels)
    assert np.abs(model[0] - again[0]).max() < 1.0


def test_quality_fits_are_averaged(spark, corpus, monkeypatch):
    docs, labels, truth = corpus
    monkeypatch.setattr(quality, "LINES_PER_TASK", 900)
    got = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    out = [k for k in truth if held(k, 5) == 0]
    assert np.mean([(got[k] >= 0.3) == (truth[k][0] == 1) for k in out]) > 0.95


def test_columns_with_the_operators_own_names(spark, corpus):
    docs, labels, _ = corpus
    odd = docs.selectExpr("doc_id", "text", "text as _id", "text as _text", "row", "score")
    model = toxicity.fit(docs, labels)
    assert toxicity.drop_toxic(odd, model).columns == odd.columns
    assert langid.predict(docs.selectExpr("doc_id", "text", "1 as lang_pred", "2 as score", "3 as _id"), (["a"], np.zeros((1 << langid.BITS, 1), np.float32))).count() == docs.count()


def test_many_languages(spark):
    names = [f"l{i:03d}" for i in range(120)]
    rows = [(i, " ".join(f"{names[i % 120][1:].translate(str.maketrans('0123456789', 'abcdefghij'))}{x}" for x in "qrstuvwxyz"), names[i % 120]) for i in range(480)]
    docs = spark.createDataFrame(rows + [(1000, None, "l001"), (1001, "abc def", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert np.mean([got[k] == lang for k, _, lang in rows]) > 0.9 and got[1000] == "und"
