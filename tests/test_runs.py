import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltworks.functions import scoring
from siltworks.operators import review, select
from siltworks.plans import runs
from siltworks.sources import landed

RULES = scoring.Rules(routes={"r.a": {"alpha": 9}, "r.b": {"beta": 9}}, types={"t.x": ("alpha",), "t.y": ("beta",)}, type_precedence=("t.x", "t.y"), tags={"scene": {"scene.b": ("beta",)}})
QUOTA = select.Quota(target=10, minimum=2, minimum_score=7, first_priority=9)


def feed(n):
    word = lambda i: "alpha" if i % 2 else "beta"
    items = "".join(f"<item><title>{word(i)} story {chr(97 + i) * 6} {chr(110 + i) * 5} number</title><link>https://e.org/{i}</link><pubDate>Wed, 05 Aug 2026 0{i}:00:00 +0000</pubDate></item>" for i in range(n))
    return f"<rss>{items}</rss>"


def rss(pages):
    return landed.feed_entries(pages).select("registry_id", F.col("link").alias("url"), F.col("title").alias("raw_title"), F.col("excerpt").alias("raw_excerpt"), F.col("authors").alias("author"), "published_at")


@pytest.fixture
def collected(spark):
    pages = spark.createDataFrame([("s1", "https://e.org/f", feed(6), None), ("s2", "https://e.org/g", None, "timeout"), ("s3", "https://e.org/h", "x", None), ("s4", "https://e.org/off", feed(9), None)], "registry_id string, url string, body string, reason string")
    specs = [("s1", "rss", "S1", "company_news", "P", "en", True), ("s2", "rss", "S2", "company_news", None, "en", True), ("s3", "odd", "S3", "company_news", None, "en", True), ("s4", "rss", "S4", "company_news", None, "en", False)]
    registry = spark.createDataFrame(specs, "registry_id string, adapter string, source_name string, source_type string, publisher string, language string, enabled boolean")
    return runs.collect(pages, registry, {"rss": rss}, dt.datetime(2026, 8, 12)), registry, pages


def test_collect(spark, collected):
    (records, checks), registry, pages = collected
    rows = records.collect()
    assert sum(r.access_status == "success" for r in rows) == 6
    assert {r.failure_reason for r in rows if r.access_status == "failed"} == {"timeout", "unknown adapter: odd"}
    assert {(r.registry_id, r.status, r.accepted) for r in checks.collect()} == {("s1", "success", 6), ("s2", "failed", 0), ("s3", "failed", 0)}
    with pytest.raises(ValueError, match="unknown"):
        runs.collect(pages, registry, {"rss": rss}, None, ["nope"])


def test_run_waits_for_a_person(spark, collected, tmp_path):
    records = collected[0][0]
    run = runs.Run(str(tmp_path / "state"), "run_1")
    queue = runs.start(run, records, RULES, QUOTA, str(tmp_path / "tables")).collect()
    assert run.state == "waiting_for_review" and len(queue) == 6 and runs.latest(str(tmp_path / "state")).state == "waiting_for_review"
    assert {r.type for r in queue} == {"t.x", "t.y"} and {r.tags.scene[0] for r in queue} == {"scene.general", "scene.b"}
    rows = [(q.candidate_id, q.primary_source_id, "T", "u", dt.datetime(2026, 8, 5), "verified_primary", [("Fact", "fact", "p", None)], "l", "include", "d", (f"e{i}", "T", "k", "r", "priority.p1", "c", "N", ["t"])) for i, q in enumerate(queue)]
    gate = {"status": "approved", "verified_at": "x", "verified_by": "y"}
    with pytest.raises(ValueError, match="missing_queued"):
        runs.resume(run, spark, spark.createDataFrame(rows[:5], review.REVIEW), str(tmp_path / "tables"), **gate)
    assert run.state == "waiting_for_review"
    claims, events = runs.resume(run, spark, spark.createDataFrame(rows, review.REVIEW), str(tmp_path / "tables"), **gate)
    assert claims.count() == events.count() == 6
    base = tmp_path / "tables" / "run_1"
    stories = spark.read.parquet(str(base / "stories")).orderBy("rank").collect()
    assert [s.article_type for s in stories] == ["deep_dive"] * 5 + ["brief"] and spark.read.parquet(str(base / "days")).count() == 7
    assert {r.event_id for r in spark.read.parquet(str(base / "trend_members")).collect()} == {f"e{i}" for i in range(6)}
    assert {r.story_id for r in spark.read.parquet(str(base / "day_members")).collect()} == {s.story_id for s in stories}
    assert "# Verified events" in spark.read.text(str(base / "report")).first().value and spark.read.parquet(str(base / "issue")).first().events == 6
    assert runs.Run.load(str(tmp_path / "state"), "run_1").history == ["initialized", "running", "waiting_for_review", "running", "completed"]
    with pytest.raises(ValueError):
        run.move("running")


def test_bad_records_fail_the_run(spark, collected, tmp_path):
    run = runs.Run(str(tmp_path), "run_2")
    with pytest.raises(ValueError, match="canonical_url"):
        runs.start(run, collected[0][0].withColumn("canonical_url", F.lit("nope")), RULES, QUOTA, str(tmp_path / "t"))
    assert run.state == "failed"


def test_enriched_run(spark, collected, tmp_path):
    records, asked = collected[0][0], str(tmp_path / "asked")

    def provider(texts):
        import json
        from pathlib import Path

        from siltworks.operators import enrich

        with open(asked, "a") as file:
            file.write("x" * len(texts))
        assert Path(asked).exists()
        return [json.dumps(json.loads(a) | {"intelligence_type": "t.y", "strategy_relevance_score": 40, "recommended_disposition": "p2"}) for a in enrich.stub(texts)]

    run = runs.Run(str(tmp_path / "state"), "run_e")
    settings = enrich_settings(4)
    queue = runs.start(run, records, RULES, QUOTA, str(tmp_path / "tables"), provider=provider, settings=settings).collect()
    assert len(open(asked).read()) == 4 and sum(r.model_priority == "p2" for r in queue) == 4 and all(r.type == "t.y" for r in queue if r.model_priority)
    # Equal inputs are not asked again.
    cache = spark.read.parquet(str(tmp_path / "tables" / "run_e" / "answers"))
    again = runs.start(runs.Run(str(tmp_path / "state"), "run_f"), records, RULES, QUOTA, str(tmp_path / "tables"), provider=provider, cache=cache.union(cache), settings=settings)
    assert again.count() == len(queue) and len(open(asked).read()) == 4


def test_structure_accounts_for_every_record(spark):
    from siltworks.operators import validate

    rules = scoring.Rules(
        routes={"r.a": {"alpha": 9}, "r.b": {"beta": 9}}, hard_terms=("spam",), soft_terms={"rumour": -2, "hearsay": -1},
        types={"t.x": ("alpha",), "t.y": ("beta",)}, type_precedence=("t.x", "t.y"), source_boosts={"blog": {"t.y": 1}},
    )
    titles = ["alpha spam one", "alpha rumour about wolves", "nothing of note", "hearsay without a route", "beta from a quiet harbour", "beta from a quiet harbour", "alpha commit one", "alpha commit of another kind", "Alpha lonely"]
    rows = [(f"src_{i}", t, None, "repo" if "commit" in t else "blog", "blog", f"p{i % 2 if 'beta' not in t else 0}", dt.datetime(2026, 8, 1 + i), f"https://e.org/{i}", "success", None) for i, t in enumerate(titles)]
    rows += [("src_x", "alpha failed", None, "blog", "blog", "p", None, "https://e.org/x", "failed", "timeout")]
    kind = "source_id string, raw_title string, raw_excerpt string, source_name string, source_type string, publisher string, published_at timestamp, canonical_url string, access_status string, discovery_context string"
    wording = select.Wording(routes={"r.a": "Alpha moves"}, by_route={"r.b": "Is beta final?"})
    made = runs.structure(spark.createDataFrame(rows, kind), rules, select.Quota(target=10, minimum=2, minimum_score=7, first_priority=9), "repo", "The repository", wording=wording, expected=["Alpha lonely", "alpha spam one", "alpha failed", "never seen"])
    got = {(r.source_id, r.reason): r.terms for r in made.exclusions.collect()}
    assert got == {("src_0", "excluded"): ["spam"], ("src_1", "demoted"): ["rumour"], ("src_2", "unrouted"): [], ("src_3", "unrouted"): [], ("src_3", "demoted"): ["hearsay"]}
    candidates = {r.canonical_title: r for r in made.candidates.collect()}
    assert set(candidates) == {"alpha rumour about wolves", "beta from a quiet harbour", "The repository", "Alpha lonely"}
    assert candidates["alpha rumour about wolves"].negative_signals == ["rumour"] and candidates["Alpha lonely"].negative_signals == []
    assert candidates["Alpha lonely"].type_signals == ["content:alpha"] and candidates["beta from a quiet harbour"].type_signals == ["content:beta", "source_type:blog", "source_type:blog"]
    assert candidates["Alpha lonely"].why_candidate == "Alpha moves; signals: alpha." and candidates["The repository"].why_candidate.startswith("A watched source")
    assert candidates["beta from a quiet harbour"].verification_questions == ["What is new?", "Where does the source state it?", "Is beta final?"]
    assert candidates["The repository"].verification_questions == ["What changed in the watched source, and when?"]
    recalled = {r.title: (r.present, r.selected) for r in made.recall.collect()}
    assert recalled == {"Alpha lonely": (True, True), "alpha spam one": (True, False), "alpha failed": (False, False), "never seen": (False, False)}
    report = {(r.figure, r.of): r.n for r in made.report.collect()}
    assert report == {
        ("input_records", None): 10, ("scored", None): 9, ("excluded", None): 1, ("demoted", None): 2, ("unrouted", None): 2, ("routed", None): 6, ("candidates", None): 4, ("selected", None): 4,
        ("recall_present", None): 2, ("recall_selected", None): 1, ("collapsed", "single"): 0, ("collapsed", "near_title"): 1, ("collapsed", "fixed_cluster"): 1,
        ("selected_by_type", "t.x"): 3, ("selected_by_type", "t.y"): 1, ("selected_by_route", "r.a"): 3, ("selected_by_route", "r.b"): 1,
    }
    chosen = made.candidates.filter("status = 'selected'")
    check = lambda df, n: [r.rule for r in validate.shortlist(df, made.candidates.filter("status = 'overflow'"), least=1, types=list(rules.types), type_caps={}, route_minimums={}, recall=made.recall, fixed_title="The repository", collapsed=n).collect()]
    assert check(chosen, 1) == ["recall"] and set(check(chosen, 4)) == {"recall", "fixed_cluster"}
    assert set(check(chosen.filter("method <> 'fixed_cluster'"), 1)) == {"recall", "fixed_cluster"}
    assert set(check(chosen.withColumn("verification_questions", F.array().cast("array<string>")).withColumn("status", F.lit("verified")), 1)) == {"recall", "questions", "status"}


def test_structure_of_nothing(spark):
    kind = "source_id string, raw_title string, raw_excerpt string, source_name string, source_type string, publisher string, published_at timestamp, canonical_url string, access_status string, discovery_context string"
    made = runs.structure(spark.createDataFrame([], kind), RULES, QUOTA, expected=["a"])
    assert made.candidates.count() == made.exclusions.count() == 0 and made.recall.collect() == [("a", False, False)]
    assert {r.figure: r.n for r in made.report.collect()} == {"input_records": 0, "scored": 0, "excluded": 0, "demoted": 0, "unrouted": 0, "routed": 0, "candidates": 0, "selected": 0, "recall_present": 0, "recall_selected": 0}


def enrich_settings(most):
    from siltworks.operators import enrich

    return enrich.Settings(most_candidates=most)
