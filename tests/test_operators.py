import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from siltworks.functions.text import normalize_title
from siltworks.operators import cluster, dedupe, editorial, enrich, joins, review, select, summaries, validate

T = lambda s: F.lit(s).cast("timestamp")


def test_best_access_and_overlay(spark):
    rows = [("u", "failed", 1, "a"), ("u", "success", 2, "a"), ("u", "success", 3, "a"), ("v", "odd", 4, "b"), ("v", "failed", 5, "b")]
    df = spark.createDataFrame(rows, "canonical_url string, access_status string, ord long, registry_id string")
    for n in (1, 8):
        got = {r.canonical_url: r.ord for r in dedupe.best_access(df.repartition(n)).collect()}
        assert got == {"u": 2, "v": 5}
    at = dt.datetime(2026, 8, 6)
    cur = [("a", "u1", "failed", 1, at), ("b", "u2", "success", 2, at)]
    old = [("a", "u3", "success", 3, at), ("a", "u2", "success", 4, at), ("a", "u4", "success", 5, dt.datetime(2025, 1, 1)), ("b", "u5", "success", 6, at)]
    kind = "registry_id string, canonical_url string, access_status string, ord long, published_at timestamp"
    got = dedupe.overlay_fallback(spark.createDataFrame(cur, kind), spark.createDataFrame(old, kind), T("2026-08-05"), T("2026-08-12"))
    assert {(r.canonical_url, r.restored) for r in got.collect()} == {("u2", False), ("u3", True)}
    # A failed source without records, named by its check; of a restored source what was no success goes.
    cur = [("a", "u1", "blocked", 1, at), ("a", "u6", "success", 7, at), ("c", "u7", "partial", 8, at)]
    failed = spark.createDataFrame([("a",), ("b",)], "registry_id string")
    made = dedupe.overlay_fallback(*[spark.createDataFrame(x, kind).withColumn("discovery_context", F.lit("")) for x in (cur, old)], T("2026-08-05"), T("2026-08-12"), failed=failed, run_id="r9")
    assert {(r.canonical_url, r.restored, r.discovery_context) for r in made.collect()} == {("u6", False, ""), ("u7", False, ""), *((u, True, "fallback_collection:r9") for u in ("u2", "u3", "u5"))}
    assert {(r.registry_id, r.restored_records) for r in dedupe.fallback_counts(made).collect()} == {("a", 2), ("b", 1)}


def greedy(rows, threshold=0.9):
    from siltworks.operators.cluster import title_similarity

    leaders, out = [], {}
    for pub, score, title, norm, ord_ in sorted(rows, key=lambda r: (-r[1], r[2], r[4])):
        lead = next((o for p, n, o in leaders if p == pub and (n == norm or title_similarity(norm, n) >= threshold)), None)
        if lead is None:
            leaders.append((pub, norm, ord_))
            lead = ord_
        out[ord_] = lead
    return out


def test_near_title_groups_are_the_greedy_ones(spark):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(30)]
    base = [" ".join(rng.choices(words, k=8)) for _ in range(12)]
    titles = []
    for _ in range(120):
        t = rng.choice(base).split()
        if rng.random() < 0.6:
            t[rng.randrange(8)] = rng.choice(words) if rng.random() < 0.5 else t[0] + "s"
        titles.append(" ".join(t))
    rows = [(i, rng.choice(["p", "q", None]), t, rng.randrange(4)) for i, t in enumerate(titles)] + [(500, "p", "", 1), (501, "p", "", 2)]
    df = spark.createDataFrame(rows, "ord long, publisher string, title string, score int")
    got = {r.ord: r.leader for r in cluster.group_titles(df).collect()}
    norm = {r.ord: r.n for r in df.select("ord", normalize_title(F.col("title")).alias("n")).collect()}
    assert got == greedy([(p, s, t, norm[o], o) for o, p, t, s in rows])


def test_titles_without_spaces_are_compared_by_characters(spark):
    rng = random.Random(9)
    letters = [chr(0x4E00 + i) for i in range(60)]
    base = ["".join(rng.choices(letters, k=rng.choice([9, 12, 20, 31]))) for _ in range(10)] + ["one-word-title here", "ab", "a"]
    titles = []
    for _ in range(110):
        t = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(t))
            t[k : k + rng.randrange(2)] = rng.choice(letters) if rng.random() < 0.7 else ""
            t = t or ["x"]
        titles.append("".join(t))
    rows = [(i, rng.choice(["p", None]), t, rng.randrange(4)) for i, t in enumerate(titles)]
    df = spark.createDataFrame(rows, "ord long, publisher string, title string, score int")
    got = {r.ord: r.leader for r in cluster.group_titles(df).collect()}
    norm = {r.ord: r.n for r in df.select("ord", normalize_title(F.col("title")).alias("n")).collect()}
    want = greedy([(p, s, t, norm[o], o) for o, p, t, s in rows])
    assert got == want and len(set(want.values())) < len(set(zip(norm.values(), [r[1] for r in rows])))


def test_candidate_ids_and_the_fixed_cluster(spark):
    import hashlib

    day = lambda d: dt.datetime(2026, 8, d)
    rows = [(1, 1, 5, "late", "repo", "r", [], "s1", "u1", day(9), []), (2, 2, 9, "best", "repo", "r2", [], "s2", "u2", day(8), []), (3, 3, 1, "early", "repo", "r", [], "s3", "u3", day(7), [])]
    df = spark.createDataFrame(rows, "ord long, leader long, score int, title string, source_name string, primary_route string, secondary_routes array<string>, source_id string, canonical_url string, published_at timestamp, signals array<string>")
    (r,) = cluster.roll_up(df, fixed="repo", fixed_title="The repository").collect()
    assert r.candidate_id == "cand_" + hashlib.sha256(b"The repository2026-08-07T00:00:00Z").hexdigest()[:16]
    assert (r.canonical_title, r.source_ids, r.score, r.primary_route) == ("The repository", ["s3", "s2", "s1"], 12, "r2")


def test_stories_are_ranked_without_one_task(spark):
    rows = [(f"e{i:03d}", ["priority.p0", "priority.p1", "none"][i % 3], dt.datetime(2026, 8, 1 + i % 4, i % 7)) for i in range(90)] + [("e900", "none", None)]
    df = spark.createDataFrame(rows, "event_id string, priority string, event_at timestamp")
    want = sorted(rows, key=lambda r: ({"priority.p0": 0, "priority.p1": 1}.get(r[1], 9), r[2] or dt.datetime(1, 1, 1), r[0]))
    assert [r.event_id for r in editorial.ranked(df).orderBy("rank").collect()] == [r[0] for r in want]


def test_roll_up(spark):
    at = dt.datetime(2026, 8, 5)
    rows = [(1, 1, 5, "b", "repo", "r", [], "s1", "u1", at, ["x"]), (2, 1, 9, "a", "blog", "r2", ["r"], "s2", "u2", None, ["y", "x"]), (3, 3, 1, "c", "fixed", "r", [], "s3", "u3", at, [])]
    df = spark.createDataFrame(rows, "ord long, leader long, score int, title string, source_name string, primary_route string, secondary_routes array<string>, source_id string, canonical_url string, published_at timestamp, signals array<string>")
    got = {r.canonical_title: r for r in cluster.roll_up(df, fixed="fixed").collect()}
    assert got["a"].source_ids == ["s2", "s1"] and got["a"].matched_signals == ["x", "y"] and got["a"].published_at == at and got["a"].method == "near_title"
    assert (got["c"].score, got["c"].track, got["c"].method) == (4, "track.fixed", "fixed_cluster")


def full_quota(rows, q):
    """All phases over all rows, without pruning."""
    pinned = [(c["type"], c["route"]) for c in rows if c["title"] in q.pinned_titles]
    return select.fill_quota([c for c in rows if c["title"] not in q.pinned_titles], q, pinned)


def test_quota(spark):
    rng = random.Random(3)
    rows = [(f"c{i}", f"t{rng.randrange(200)}", rng.choice("xyz"), rng.choice(["r1", "r2", "r3", None]), rng.randrange(20)) for i in range(400)]
    q = select.Quota(target=12, minimum=6, minimum_score=7, type_minimums={"x": 3, "y": 2}, type_caps={"x": 5, "y": 4, "z": 4}, route_minimums={"r1": 2, "r3": 3}, route_caps={"r1": 5, "r2": 4}, pinned_titles=("t7",))
    df = spark.createDataFrame(rows, "candidate_id string, title string, type string, route string, score int").withColumn("track", F.lit("track.emerging"))
    got = select.select_quota(df, q).collect()
    assert len(got) == 400
    able = sorted(({"id": i, "title": t, "type": k, "route": r, "score": s} for i, t, k, r, s in rows if r and s >= 7), key=lambda c: (-c["score"], c["title"], c["id"]))
    pins = {c["id"] for c in able if c["title"] == "t7"}
    assert {r.candidate_id for r in got if r.status == "selected"} == set(full_quota(able, q)) | pins
    assert all(r.status == "below_threshold" for r in got if r.route and r.score < 7) and all(r.status == "unrouted" for r in got if not r.route)
    chosen = [r for r in got if r.status == "selected"]
    assert all(sum(r.type == k for r in chosen) <= c for k, c in q.type_caps.items())
    assert {r.priority for r in chosen} <= {"priority.p1", "priority.p2"}


def test_quota_never_evicts_below_a_route_minimum():
    q = select.Quota(target=4, minimum=0, type_caps={"x": 1}, route_minimums={"r": 2})
    rows = [{"id": str(i), "title": "t", "type": "x", "route": "r", "score": 9} for i in range(3)]
    assert len(select.fill_quota(rows, q)) == 2


def test_review_queue(spark):
    rows = [("a", "A", "x", 20, "priority.p1", None, 0), ("b", "B", "x", 19, "priority.p1", None, 0), ("c", "C", "y", 5, "priority.p2", "p2", 90), ("d", "D", "y", 9, "priority.p2", "p1", 10), ("e", "E", "y", 9, "priority.p2", "reject", 99)]
    df = spark.createDataFrame(rows, "candidate_id string, title string, type string, score int, priority string, model_priority string, relevance int")
    got = [(r.candidate_id, r.queued_for) for r in select.review_queue(df, most=3, type_minimums={"y": 2}).collect()]
    assert got == [("a", "priority"), ("b", "priority"), ("d", "type_minimum")]


def reviews(spark, n=5, **change):
    rows = []
    for i in range(n):
        event = (f"e{i}", f"Title {i}", "release", "route.a", "priority.p1", "medium", f"Entity {i}", ["tag"])
        row = {"candidate_id": f"cand_{i}", "source_id": f"s{i}", "title": f"T{i}", "url": "https://e.org", "published_at": dt.datetime(2026, 8, 5 + i), "verification_status": "verified_primary", "claims": [("A fact.", "fact", "p. 1", None), ("More", "fact", "p. 2", None)], "limitation": "small", "decision": "include", "decision_reason": "new", "event": event}
        rows.append(row)
    for k, v in change.items():
        rows[0][k] = v
    return spark.createDataFrame([tuple(r.values()) for r in rows], review.REVIEW)


def candidates(spark, n=5):
    return spark.createDataFrame([(f"cand_{i}", [f"x{i}"], "track.emerging") for i in range(n)], "candidate_id string, source_ids array<string>, track string")


GATE = {"status": "approved", "verified_at": "2026-08-12", "verified_by": "someone"}


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"claims": []}, "no_claims"),
        ({"claims": [("", "fact", "p", None)]}, "claim_fields"),
        ({"limitation": " "}, "limitation"),
        ({"decision": "maybe"}, "decision"),
        ({"decision_reason": None}, "decision_reason"),
        ({"verification_status": "pending"}, "source_unverified"),
        ({"candidate_id": "cand_9"}, "unknown_candidate"),
        ({"candidate_id": "cand_1"}, "duplicate_candidate"),
        ({"event": None}, "event_fields"),
        ({"event": ("e1", "T", "k", "r", "p", "c", "n", ["t"])}, "duplicate_event"),
        ({"decision": "watch"}, "event_count"),
    ],
)
def test_gate_rules(spark, change, rule):
    c = candidates(spark)
    assert rule in {r.rule for r in review.violations(reviews(spark, **change), c, c, **GATE).collect()}


def test_gate_head_and_bundle(spark):
    c, r = candidates(spark), reviews(spark)
    assert review.violations(r, c, c, **GATE).isEmpty()
    assert {x.rule for x in review.violations(r, c, candidates(spark, 6), status="pending").collect()} == {"approved", "verifier", "missing_queued"}
    with pytest.raises(ValueError, match="limitation"):
        review.build(reviews(spark, limitation=""), c, c, **GATE)
    claims, events = review.build(r, c, c, **GATE)
    assert claims.count() == 10 and claims.orderBy("claim_id").first().claim_id == "clm_0_01"
    first = events.orderBy("event_id").first()
    assert first.source_ids == ["s0", "x0"] and first.fact_summary == "A fact; More." and first.dedupe_key == "entity_0|release|2026-08-05"
    sources = spark.createDataFrame([(f"s{i}", "P") for i in range(5)] + [(f"x{i}", "P") for i in range(5)], "source_id string, publisher string")
    assert {x.publishers for x in review.independent_publishers(events, sources).collect()} == {1}
    assert validate.verified(events, claims, sources).isEmpty()
    assert "unknown_source" in {x.rule for x in validate.verified(events, claims, sources.filter("source_id <> 's0'")).collect()}
    stories = editorial.stories(events)
    days, trends = editorial.timeline(events, category="primary_route"), editorial.trends(events)
    assert days.count() == 7 and trends.first().score == 95
    assert validate.issue(stories, events, claims, days, trends).isEmpty()
    assert [r.rank for r in review.ranked_events(events).orderBy("event_at").collect()] == [1, 2, 3, 4, 5]
    assert editorial.issue(events).first().issue_id == "issue_2026_w32"
    with pytest.raises(ValueError):
        review.apply_selection(r, ["cand_0"], ["cand_1"])
    chosen = review.apply_selection(r, [f"cand_{i}" for i in range(4)], ["cand_4"])
    assert summaries.decisions(chosen).first().include == 4


def test_timeline_folds_dates_outside(spark):
    rows = [(i, dt.datetime(2026, 8, d), "k") for i, d in enumerate((1, 9, 9, 12))]
    got = editorial.timeline(spark.createDataFrame(rows, "event_id int, event_at timestamp, category string")).orderBy("day").collect()
    assert len(got) == 7 and got[0].label == "08.01-08.01" and sum(r.events for r in got) == 4 and got[1].events == 0


def test_shortlist_rules(spark):
    kind = "candidate_id string, reason string, type string, route string"
    few = spark.createDataFrame([("a", "r", "x", "r1"), ("a", "", "q", "r1")], kind)
    over = spark.createDataFrame([("b", "r", "y", "r2")], kind)
    rules = {r.rule for r in validate.shortlist(few, over, types=["x", "y"], type_caps={"x": 0}, route_minimums={"r2": 1, "r3": 1}).collect()}
    assert rules == {"size", "duplicate_id", "reason", "known_type", "type_cap", "type_retained", "route_minimum"}


def test_joins(spark):
    c = spark.createDataFrame([("c", ["b", "zz", "a"])], "candidate_id string, source_ids array<string>")
    s = spark.createDataFrame([("a", 1), ("b", 2)], "source_id string, v int")
    got = joins.collect_members(joins.members(c, s), "candidate_id", "source_id").first()
    assert [x.source_id for x in got.sources] == ["b", "a"]
    w = spark.createDataFrame([("a",), ("b",)], "k string")
    g = spark.createDataFrame([("b",), ("b",), ("z",)], "k string")
    assert {(r.k, r.problem) for r in joins.coverage(w, g, "k").collect()} == {("a", "missing"), ("b", "duplicate"), ("z", "unexpected")}
    assert joins.same_set(w, w) and not joins.same_set(w, g)
    specs = spark.createDataFrame([("s", "g"), ("t", None)], "registry_id string, keyword_group string")
    groups = spark.createDataFrame([("g", "y"), ("g", "x")], "keyword_group string, term string")
    assert {r.registry_id: r.keywords for r in joins.with_keywords(specs, groups).collect()} == {"s": ["x", "y"], "t": []}
    old = spark.createDataFrame([("s", "o")], "registry_id string, keyword_group string")
    assert {r.keyword_group for r in joins.carry_over(specs, old, "registry_id", "keyword_group").collect()} == {"g", None}


def test_enrichment(spark):
    kind = "candidate_id string, canonical_title string, primary_route string, score int, matched_signals array<string>, source_ids array<string>"
    c = spark.createDataFrame([("c1", "T", "r", 20, ["a", "routing_context:b"], ["s1"]), ("c2", "U", "r", 1, [], ["s2"])], kind)
    m = spark.createDataFrame([("c1", 0, "s1", "P", "blog", "T", "E" * 2000, None, "u")], "candidate_id string, place int, source_id string, publisher string, source_type string, raw_title string, raw_excerpt string, raw_text string, canonical_url string")
    wanted = enrich.inputs(c, m)
    text = {r.candidate_id: r.input for r in wanted.collect()}
    assert "routing_context" not in text["c1"] and "E" * 1800 in text["c1"] and "E" * 1801 not in text["c1"]
    first = enrich.enrich(wanted)
    assert {r.cached for r in first.collect()} == {False}
    again = enrich.enrich(wanted, first.filter("candidate_id = 'c1'"))
    assert {r.candidate_id: r.cached for r in again.collect()} == {"c1": True, "c2": False}
    analyses = first.select("analysis.*")
    assert enrich.violations(analyses, c, ["technology"]).isEmpty()
    bad = analyses.withColumn("confidence", F.lit("high")).withColumn("proposed_claims", F.array(F.lit(" TODO "))).filter("candidate_id = 'c1'").withColumn("recommended_disposition", F.lit("reject"))
    assert {r.rule for r in enrich.violations(bad, c, ["other"]).collect()} == {"type", "overconfident", "placeholder", "high_score_rejected", "missing"}
    odd = analyses.withColumn("source_ids", F.array(F.lit("zz")))
    assert {r.candidate_id: r.source_ids for r in enrich.clamp_sources(odd, c).collect()} == {"c1": ["s1"], "c2": ["s2"]}
    with pytest.raises(ValueError):
        enrich.Settings.from_env({"SILTWORKS_MODEL_BASE_URL": "http://example.org"})
    assert enrich.Settings.from_env({"SILTWORKS_MODEL_BATCH": "3"}).batch == 3


def test_runs_by_length_lose_no_pair(spark):
    from collections import Counter
    from difflib import SequenceMatcher

    rng, rows = random.Random(4), []
    for letters in ("ab", "abcdefgh ", "机器学习模型视频生成论文", "abcdefghijklmnopqrstuvwxyz "):
        for n in (2, 3, 5, 9, 14, 17, 19, 24, 38, 42, 47, 60, 110, 230):
            base = [rng.choice(letters) for _ in range(n)]
            for _ in range(5):
                title = list(base)
                for _ in range(rng.randint(0, max(1, n // 8))):
                    i = rng.randrange(len(title) + 1)
                    title[i : i + rng.randint(0, 1)] = rng.choice([[], [rng.choice(letters)]])
                if title:
                    rows.append("".join(title))
    rows = [(i, "p" if i % 50 else None, t, i) for i, t in enumerate(dict.fromkeys(rows))]
    titles = spark.createDataFrame(rows, "id int, publisher string, norm string, place int")
    want = {(a, b) for a, p, x, _ in rows for b, q, y, _ in rows if a < b and p == q and min(len(x), len(y)) > 1 and SequenceMatcher(None, y, x).ratio() >= 0.9}
    got = {(r.a, r.b) for r in cluster.ratio_pairs(titles, 0.9).collect()}
    assert len(want) > 100 and want <= got
    texts = [t for _, _, t, _ in rows]
    for q in (2, 3, 4):
        counts = [Counter(t[i : i + q] for i in range(len(t) - q + 1)) for t in texts]
        assert cluster.shared_runs(texts[1:], texts[:-1], q).tolist() == [(a & b).total() for a, b in zip(counts[1:], counts)]
    assert {(r.a, r.b) for r in cluster.similar_titles(titles).collect()} == {(a, b) for a, p, x, _ in rows for b, q, y, _ in rows if a < b and p == q and cluster.title_similarity(y, x) >= 0.9 and min(len(x), len(y)) > 1}


def test_closed_schema_names_each_fault(spark):
    import json

    good = {f: "x" for f in enrich.TEXT_FIELDS} | {f: ["r"] for f in enrich.LIST_FIELDS} | {f: 0 for f in enrich.SCORE_FIELDS}
    good |= {"intelligence_type": "news", "primary_route": "r", "track": "track.emerging", "confidence": "high", "recommended_disposition": "watch"}
    drop = lambda f: {k: v for k, v in good.items() if k != f}
    rows = [("ok", json.dumps(good)), ("empty", json.dumps(good | {"source_ids": []})), ("null", None), ("list", "[]"), ("text", '"x"'), ("two", json.dumps(drop("why") | {"b": 1, "importance_score": "7"}))]
    rows += [("mixed", json.dumps(good | {"source_ids": ["a", 1]})), ("nulls", json.dumps(good | {"what": None, "novelty_score": None, "source_ids": None})), ("low", json.dumps(good | {"importance_score": -1})), ("route", json.dumps(good | {"primary_route": "q"}))]
    got = sorted(map(tuple, enrich.schema_violations(spark.createDataFrame(rows, "candidate_id string, answer string"), ["news"], ["r"]).collect()))
    assert got == sorted(
        [("not_json", k, "") for k in ("null", "list", "text")]
        + [("missing", "two", "why"), ("extra", "two", "b"), ("type", "two", "importance_score"), ("type", "mixed", "source_ids")]
        + [("type", "nulls", f) for f in ("what", "novelty_score", "source_ids")]
        + [("value", "low", "importance_score"), ("value", "route", "primary_route")]
    )


def test_pairs_carry_no_texts_and_an_id_may_stand_twice(spark):
    from siltworks.operators import cluster

    shared = [f"word{k}" for k in range(30)]
    rows = [(i, "p", " ".join([*shared, f"own{i}", f"other{i}"])) for i in range(60)] + [(1, "q", "alpha beta gamma"), (70, "q", "alpha beta gamma delta")]
    titles = spark.createDataFrame(rows, "id long, publisher string, norm string").withColumn("place", F.struct(F.col("id").alias("o")))
    got = sorted(map(tuple, cluster.jaccard_pairs(titles, 0.6).collect()))
    assert got == sorted([(a, b, 30 / 34) for a in range(60) for b in range(a + 1, 60)] + [(1, 70, 0.75)])
    assert cluster._word_pairs(cluster._worded(titles), 0.6).columns == ["a", "_a", "b", "_b"]


def test_inputs_are_made_once_and_asked_in_batches(spark, tmp_path):
    """inputs were made once for cached rows and again for fresh ones, and each batch of eight was a frame of its own."""
    import json

    spark.range(50).selectExpr("cast(id as string) AS candidate_id", "concat('in', id) AS input", "concat('f', id) AS fingerprint").coalesce(1).write.parquet(f"{tmp_path}/w")
    wanted = spark.read.parquet(f"{tmp_path}/w")
    cache = spark.createDataFrame([(str(i), f"f{i}", json.dumps({"candidate_id": str(i), "importance_score": -1})) for i in range(0, 50, 3)] + [("1", "old", "{}")], "candidate_id string, fingerprint string, answer string")
    told = lambda texts: [json.dumps({"candidate_id": t[2:], "importance_score": len(texts)}) for t in texts]
    made = enrich.enrich(wanted, cache, told)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    rows = {r.candidate_id: r for r in made.collect()}
    assert len(rows) == 50 and all(r.analysis.candidate_id == k and r.cached == (int(k) % 3 == 0) and r.fingerprint == f"f{k}" for k, r in rows.items())
    assert all(r.analysis.importance_score == -1 if r.cached else 1 <= r.analysis.importance_score <= 8 for r in rows.values())
    assert {r.cached for r in enrich.enrich(wanted.filter("candidate_id % 3 = 0"), cache, told).collect()} == {True}
    with pytest.raises(Exception, match="must answer every input"):
        enrich.enrich(wanted, cache, lambda texts: texts[1:]).collect()
