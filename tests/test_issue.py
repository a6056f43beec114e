"""Whole issues: stories as readers see them, nested documents, and each rule planted."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from siltworks.operators import editorial, validate

EVENT = "issue_key int, event_id string, canonical_title string, priority string, event_at timestamp, fact_summary string, limitations string, claim_ids array<string>, primary_source_id string, primary_route string, entity_name string"


@pytest.fixture(scope="module")
def made(spark):
    def event(key, i, day, priority="priority.p1", route="r"):
        return (key, f"e{key}-{i}", f"T{i}", priority, dt.datetime(2026, 8, day), f"fact {i}", "only so", [f"c{key}-{i}-1", f"c{key}-{i}-2"], f"s{i}", route, "Ann" if i else None)

    rows = [event(1, i, 3 + i, "priority.p0" if i == 6 else "priority.p1", "r" if i % 2 else "q") for i in range(7)] + [event(2, i, 5) for i in range(4)] + [event(3, i, 1 + 2 * i) for i in range(5)]
    events = spark.createDataFrame(rows, EVENT)
    claims = spark.createDataFrame([(c, f"says {c}") for r in rows for c in r[7]] + [("c1-0-1", "says c1-0-1")], "claim_id string, claim_text string")
    reviews = spark.createDataFrame([(r[1], "https://a.org/x", "why" if r[1] != "e1-1" else " ") for r in rows] + [("e1-2", "https://b.org/y", "other")], "event_id string, url string, decision_reason string")
    tops = spark.createDataFrame([(1, k, e) for k, e in enumerate(["e1-5", "e1-0", "none", "e1-5", "e1-1", "e1-2", "e1-3", "e1-4"])], "issue_key int, place int, event_id string")
    numbers = spark.createDataFrame([("e1-0", 2, "b", "2 %", "c1-0-2"), ("e1-0", 1, "a", "1", "c1-0-1")], "event_id string, place int, label string, value string, claim_id string")
    told = editorial.reader_stories(events, claims, reviews, tops=tops.unionByName(spark.createDataFrame([(3, i, f"e3-{i}") for i in range(5)], tops.schema)), numbers=numbers, labels=[("a.org", "A")], categories={"r": "Robots"}, watch=["next?"])
    return told, events, claims


@pytest.fixture(scope="module")
def document(made):
    return {r.issue_key: json.loads(r.document) for r in editorial.issue_documents(*made).collect()}


def test_stories_have_all_sections_and_the_list_overrides_rank(made):
    rows = {r.primary_event_id: r for r in made[0].filter("issue_key = 1").collect()}
    assert len(rows) == 7 and rows["e1-6"].rank == 0 and rows["e1-6"].article_type == "brief" and rows["e1-6"].our_take is None
    assert [e for e, r in sorted(rows.items(), key=lambda x: (x[1].top_place is None, x[1].top_place)) if r.top_place is not None] == ["e1-5", "e1-0", "e1-1", "e1-2", "e1-3"]
    a = rows["e1-0"]
    assert a.dek == "says c1-0-1" and a.under_the_hood.text == "says c1-0-2" and [n.label for n in a.key_numbers] == ["a", "b"] and a.category == "general" and a.reading_time_minutes == 5
    assert rows["e1-1"].why_it_matters.text == "fact 1" and rows["e1-2"].source_links[0].url == "https://a.org/x" and a.source_links[0].label == "A"
    assert rows["e1-3"].primary_tags == ["Robots", "Ann"] and rows["e1-6"].editorial_score == 96
    without = editorial.reader_stories(made[1], made[2], made[1].limit(0).selectExpr("event_id", "event_id AS url", "event_id AS decision_reason")).filter("issue_key = 1 and article_type = 'deep_dive'")
    assert {r.rank for r in without.collect()} == set(range(5))


def test_documents_are_closed(spark, made, document):
    assert set(document) == {1, 3}
    issue = document[1]["issue"]
    assert issue["story_count"] == 7 and issue["deep_dive_count"] == 5 and issue["lead_story_id"] == issue["top_story_ids"][0] and issue["issue_id"] == f"issue_2026_w{dt.date(2026, 8, 9).isocalendar()[1]}"
    days = document[3]["presentation"]["timeline_days"]
    assert [len(d["story_ids"]) for d in days] == [2, 0, 1, 0, 1, 0, 1] and days[0]["day"] == "2026-08-03"
    assert [len(t["event_ids"]) for t in document[1]["presentation"]["trend_radar"]] == [4, 3] and len(document[1]["evidence_claims"]) == 14
    assert validate.documents(editorial.issue_documents(*made)).isEmpty()
    assert [tuple(r) for r in validate.issue_sizes(made[0]).collect()] == [("size", "2")]


def test_each_rule_is_found_where_it_is_broken(spark, document):
    def spoil(path, value):
        doc = json.loads(json.dumps(document[1]))
        at = doc
        for p in path[:-1]:
            at = at[p]
        if value is None:
            del at[path[-1]]
        else:
            at[path[-1]] = value(at[path[-1]]) if callable(value) else value
        return json.dumps(doc)

    s, day, trend, first = ("editorial_stories", 0), ("presentation", "timeline_days"), ("presentation", "trend_radar"), document[1]["editorial_stories"][0]
    cases = {
        "status": spoil((*s, "editorial_status"), "draft"),
        "links": spoil((*s, "source_links"), []),
        "what_happened_kind": spoil((*s, "what_happened", "statement_type"), "judgment"),
        "why_it_matters_claims": spoil((*s, "why_it_matters", "claim_ids"), ["odd"]),
        "under_the_hood_claims": spoil((*s, "under_the_hood"), {"text": "x", "statement_type": "fact"}),
        "numbers": spoil((*s, "key_numbers"), [{"label": "l", "value": "1"}]),
        "top_size": spoil(("issue", "top_story_ids"), lambda x: x[:4]),
        "lists": spoil(("issue", "brief_story_ids"), lambda x: [*x, x[0]]),
        "lead": spoil(("issue", "lead_story_id"), None),
        "seven_days": spoil(day, lambda x: x[:-1]),
        "timeline": spoil((*day, 0, "story_ids"), lambda x: x * 2 + ["story_odd"]),
        "trends": spoil(trend, []),
        "trend_events": spoil((*trend, 1, "event_ids"), ["e9"]),
        "duplicate_claim": spoil(("evidence_claims",), lambda x: [*x, x[0]]),
        "duplicate_story": spoil((*s, "story_id"), document[1]["editorial_stories"][1]["story_id"]),
        "duplicate_event": spoil((*s, "primary_event_id"), document[1]["editorial_stories"][1]["primary_event_id"]),
        "deep_dives": spoil((*s, "article_type"), "deep_dive" if first["article_type"] == "brief" else "brief"),
        "size": spoil(("editorial_stories",), lambda x: x[:4]),
        "not_json": "[]",
    }
    got = {}
    for r in validate.documents(spark.createDataFrame([*cases.items(), ("null", None), ("cut", cases["status"][:-1]), ("more", cases["status"] + "]")], "issue_key string, document string")).collect():
        got.setdefault(r.key, {})[r.rule] = r.place
    assert all(rule in got[rule] for rule in cases)
    for rule in ("status", "links", "what_happened_kind", "why_it_matters_claims", "under_the_hood_claims", "numbers"):
        assert got[rule] == {rule: first["story_id"]}
    assert got["seven_days"].keys() <= {"seven_days", "timeline"} and got["trend_events"] == {"trend_events": document[1]["presentation"]["trend_radar"][1]["trend_id"]}
    assert all(got[k].keys() == {"not_json"} for k in ("not_json", "null", "cut", "more"))


def shuffles(frame):
    """Shuffles that a plan writes, those used again counted once."""
    spark, was = frame.sparkSession, frame.sparkSession.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = frame.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_rows_of_stories_move_once_to_their_set(spark, tmp_path):
    """told stories were shuffled four times and gathered ones once more, by joins whose keys differed from the set's."""
    orders = [(i // 7, i, dt.datetime(2026, 8, 1 + i % 7)) for i in range(70)]
    spark.createDataFrame(orders, "issue_key int, n long, event_at timestamp").write.parquet(f"{tmp_path}/o")
    event = F.concat(F.lit("e"), "n")
    rows = spark.read.parquet(f"{tmp_path}/o").withColumns({"event_id": event, "canonical_title": event, "priority": F.lit("priority.p1"), "fact_summary": event, "limitations": event, "claim_ids": F.array(event), "primary_source_id": event, "primary_route": event, "entity_name": event})
    claims = rows.select(F.col("event_id").alias("claim_id"), F.col("fact_summary").alias("claim_text"))
    reviews = rows.select("event_id", F.col("event_id").alias("url"), F.col("fact_summary").alias("decision_reason"))
    told = editorial.reader_stories(rows, claims, reviews, tops=rows.select("issue_key", "event_id", F.col("n").alias("place")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved, whole = shuffles(told), shuffles(editorial.issue_documents(told, rows, claims))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("_set" in line for line in moved) == 1
    assert len(moved) <= 6 and len(whole) <= 15
    assert {r.issue_key: len(json.loads(r.document)["editorial_stories"]) for r in editorial.issue_documents(told, rows, claims).collect()} == {k: 7 for k in range(10)}


def test_a_set_without_a_key_is_an_issue(spark, made):
    none = lambda df: df.withColumn("issue_key", F.when(F.col("issue_key") != 1, F.col("issue_key")))
    told, events, claims = made
    reviews = events.select("event_id", F.lit("https://a.org/x").alias("url"), F.lit("why").alias("decision_reason"))
    tops = none(events.filter("issue_key = 1")).select("issue_key", "event_id", F.substring("event_id", 4, 1).cast("int").alias("place"))
    stories = editorial.reader_stories(none(events), claims, reviews, tops=tops)
    found = {r.issue_key: json.loads(r.document) for r in editorial.issue_documents(stories, none(events), claims).collect()}
    assert set(found) == {None, 3} and len(found[None]["evidence_claims"]) == 14 and len(found[None]["presentation"]["trend_radar"]) == 2
    assert found[None]["issue"]["top_story_ids"] == [r.story_id for r in stories.filter("issue_key is null and top_place is not null").orderBy("top_place").collect()]
    assert [r.primary_event_id for r in stories.filter("issue_key is null and top_place is not null").orderBy("top_place").collect()] == [f"e1-{i}" for i in range(5)]


def test_stories_with_their_claims_make_the_same_documents_in_fewer_moves(spark, made, tmp_path):
    """an issue's routes and claims were looked up again by event and by claim for stories that had been told from them."""
    _, events, claims = made
    lone = claims.filter("claim_id not like 'c3-%' and claim_id <> 'c1-2-1'").withColumn("kind", F.lit("k"))
    none = events.withColumns({"issue_key": F.when(F.col("issue_key") != 3, F.col("issue_key")), "primary_route": F.when(F.col("event_id") != "e1-4", F.col("primary_route"))})
    for name, frame in {"events": none, "claims": lone, "reviews": events.select("event_id", F.lit("https://a.org/x").alias("url"), F.lit("why").alias("decision_reason"))}.items():
        frame.write.parquet(f"{tmp_path}/{name}")
    none, lone, reviews = [spark.read.parquet(f"{tmp_path}/{name}") for name in ("events", "claims", "reviews")]
    plain, cited = [editorial.reader_stories(none, lone, reviews, cite=cite) for cite in (False, True)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before, after = shuffles(editorial.issue_documents(plain, none, lone)), shuffles(editorial.issue_documents(cited))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(after) <= 6 < len(before)
    found = {r.issue_key: r.document for r in editorial.issue_documents(cited).collect()}
    assert found == {r.issue_key: r.document for r in editorial.issue_documents(plain, none, lone).collect()} and set(found) == {1, None}
    first, last = json.loads(found[1]), json.loads(found[None])
    assert [c["claim_id"] for c in first["evidence_claims"]] == [f"c1-{i}-{n}" for i in (6, 0, 1, 2, 3, 4, 5) for n in (1, 2) if (i, n) != (2, 1)] and "kind" in first["evidence_claims"][0]
    assert [(t.get("route"), t["event_ids"]) for t in first["presentation"]["trend_radar"]] == [("q", ["e1-6", "e1-0", "e1-2"]), ("r", ["e1-1", "e1-3", "e1-5"]), (None, ["e1-4"])]
    assert "evidence_claims" not in last and len(last["presentation"]["trend_radar"]) == 1


def test_queries_of_issues_gather_claims_once(spark):
    """the whole job planned seventeen shuffles."""
    from siltworks.plans import run_queries

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(shuffles(run_queries.document_violations(spark, "/root/testdata/sf0.001"))) <= 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
