import re

import corpus_pipeline as P
from conftest import SMALL
from test_decontaminate import words
from test_decontaminate import brute as hits
from test_neardup import shingle_set

from siltworks.llm import toxicity


def without_windows(text, items):
    """The text without the words of windows of 13 and what stands between them."""
    found = list(re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or ""))
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), m[0]) for m in found]
    grams = {tuple(v[i : i + 13]) for _, t in items for v in [words(t)] for i in range(len(v) - 12)}
    short = {tuple(v) for _, t in items for v in [words(t)] if 0 < len(v) < 13}
    hit = set()
    for g in (grams, short):
        for n in {len(x) for x in g}:
            for i in range(len(low) - n + 1):
                if tuple(low[i : i + n]) in g:
                    hit.update((j, g is grams) for j in range(i, i + n))
    marked = {j for j, _ in hit}
    out, at, j = "", 0, 0
    while j < len(found):
        e = j
        while e in marked:
            e += 1
        if e - j >= 13:
            out, at = out + text[at : found[j].start()], found[e - 1].end()
        j = max(e, j + 1)
    return out + text[at:] if found else text


def test_skewed_table_with_nulls_and_repeats(spark, tmp_path):
    same = "a text that a third of all rows of this table hold again"
    rows = [(i, same, "en", "hot", 1) for i in range(60)]
    rows += [(100 + i, f"own words number {i} " + " ".join(f"w{i}x{j}" for j in range(30)), "en", "hot" if i % 2 else None, None) for i in range(40)]
    rows += [(100, rows[60][1], "en", None, None)] * 2 + [(None, None, None, None, None), (None, "no id", None, "x", 2), (300, None, "en", "x", 0), (301, "", "en", "x", 0), (100, "another text under the same id as before", "en", "x", 0)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "an item of the benchmark with rather more than thirteen words in it so that it has windows")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(5, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = P.run(spark, str(tmp_path)).collect()
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in got)
    assert ids == sorted([(True, 0), *[(True, 100 + i) for i in range(40)], (True, 100), (True, 300), (True, 301), (False, 0), (False, 0)])
    spark.createDataFrame([], kind).write.parquet(str(tmp_path / "empty" / "documents.parquet"))
    for name in ("benchmark", "labels"):
        spark.read.parquet(str(tmp_path / f"{name}.parquet")).limit(0).write.parquet(str(tmp_path / "empty" / f"{name}.parquet"))
    assert P.run(spark, str(tmp_path / "empty")).count() == 0


def test_stages_take_effect(spark, tmp_path):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = documents
    seen = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "mixing":
            assert out.columns == documents.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r.doc_id: r for r in docs.collect()}
    text = {r.doc_id: r.text for r in documents.collect()}
    model = toxicity.fit(documents, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score(documents, model).collect()}
    first = {k for k in text if scores[k] < 0.5}
    assert set(seen["toxicity"]) == first
    sets = {k: shingle_set(text[k]) for k in first}
    root = {k: k for k in first}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in first:
        for b in first:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    second = {find(k) for k in first}
    assert set(seen["near_duplicates"]) == second
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    third = set()
    for k in second:
        n, hit, _ = hits(text[k], items)
        if not (hit > 0 and 20 * hit >= n):
            third.add(k)
    assert set(seen["decontamination"]) == third
    for k in third:
        assert seen["decontamination"][k].text == without_windows(text[k], items)
    assert set(seen["pii"]) == third == set(seen["mixing"])
    assert all(("@" not in r.text or "example.invalid" in r.text) for r in seen["pii"].values() if r.text)
    assert sorted(map(str, P.run(spark, SMALL).collect())) == sorted(map(str, seen["mixing"].values()))


def test_operator_numbers_are_registered():
    from siltworks.llm import registry

    assert [n.split("_")[0] for n in registry.QUERIES] == [f"op{i}" for i in range(1, 11)]
