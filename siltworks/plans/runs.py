"""The three entry points as functions: collect, structure, and a run that stops for a person.

Frames are passed between stages as tables of the run's folder, so a later stage or a
restart reads what an earlier one wrote.  Only the run's small state lives on the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import records, scoring, text
from siltworks.operators import cluster, dedupe, editorial, enrich, joins, outcomes, predicates, review, select, summaries, validate
from siltworks.plans.state import Run, StaleRun, latest  # noqa: F401 - part of this module's interface
from siltworks.sources import sinks

Adapter = Callable[[DataFrame], DataFrame]


def collect(pages: DataFrame, registry: DataFrame, adapters: dict[str, Adapter], collected_at, selected: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(source records, checks) of all enabled sources.

    ``pages`` is what fetchers landed: registry_id, url, body and reason, the body null
    where fetching failed.  ``adapters`` maps a registry entry's adapter to a function
    from its pages to rows with registry_id, url, raw_title and more.  An entry without a
    known adapter, and a page that was not fetched, give a failed record and check.
    """
    specs = predicates.enabled_sources(registry, selected)
    fetched = pages.join(specs, "registry_id")
    known = F.col("adapter").isin(*adapters) if adapters else F.lit(False)
    reason = F.when(~known, F.concat(F.lit("unknown adapter: "), "adapter")).when(F.col("body").isNull(), F.coalesce("reason", F.lit("not fetched")))
    described = ["registry_id", "source_name", "source_type", "publisher", "language", "adapter"]
    bad = fetched.withColumn("why", reason).filter("why is not null")
    lost = bad.select("registry_id", "url", F.concat(F.lit("Collection failed: "), "source_name").alias("raw_title"), F.col("why").alias("failure_reason"), F.lit("failed").alias("access_status"), F.lit("metadata_only").alias("rights_scope"))
    rows = lost
    for name, adapter in adapters.items():
        mine = fetched.filter((F.col("adapter") == name) & F.col("body").isNotNull()).select("registry_id", "url", "body")
        rows = rows.unionByName(adapter(mine), allowMissingColumns=True)
    rows = rows.join(specs.select(*[F.col(c) for c in described]), "registry_id").withColumn("source_url", F.col("url"))
    made = records.to_source_record(rows, collected_at=F.lit(collected_at).cast("timestamp"), discovery_context=F.coalesce(F.col("discovery_context") if "discovery_context" in rows.columns else F.lit(None).cast("string"), F.col("adapter")))
    # The content hash orders records of one url that have the same access.
    best = dedupe.best_access(made.withColumn("ord", F.xxhash64("source_url", "content_hash"))).drop("ord")
    # A source without any landed page was not fetched; one whose pages gave nothing new is a success.
    landed = pages.select("registry_id").distinct().withColumn("_landed", F.lit(True))
    found = best.groupBy("registry_id").agg(F.count_if(F.col("access_status") == "success").alias("accepted"), F.max("failure_reason").alias("reason"))
    checks = specs.select("registry_id", "adapter").join(found, "registry_id", "left").join(landed, "registry_id", "left")
    accepted = F.coalesce("accepted", F.lit(0))
    why = F.when(F.col("_landed").isNull(), "not fetched").otherwise(F.col("reason"))
    return best, checks.select("registry_id", "adapter", F.when(accepted > 0, "success").when(why.isNotNull(), "failed").otherwise("success").alias("status"), accepted.alias("accepted"), why.alias("reason"))


@dataclass
class Structured:
    scored: DataFrame
    candidates: DataFrame
    summary: DataFrame
    exclusions: DataFrame
    recall: DataFrame
    report: DataFrame


def structure(source_records: DataFrame, rules: scoring.Rules, quota: select.Quota, fixed: str | None = None, fixed_title: str | None = None, *, wording: select.Wording | None = None, expected: list[str] = ()) -> Structured:
    """Readable records to a shortlist: score, split, group near titles, roll up, select.

    Each candidate has what spoke for its type, its negative signals, questions and, where
    selected, why.  What is set aside or marked down is listed with its terms; ``expected``
    titles are looked for in the records and in the shortlist.
    """
    readable = source_records.filter("access_status = 'success'").withColumn("ord", F.xxhash64("source_id"))
    scored = scoring.score_records(readable, rules, title="raw_title", excerpt="raw_excerpt", source_name=F.col("source_name"), context=F.col("discovery_context"))
    scored = predicates.split_scored(scored.withColumn("title", F.col("raw_title")), rules.minimum_score)
    signals = text.matches(F.concat_ws(" ", "raw_title", F.coalesce("raw_excerpt", F.lit(""))), sorted({t for r in rules.routes.values() for t in r}))
    routed = scored.filter("decision in ('eligible', 'below_threshold')").withColumn("signals", signals)
    # Records of the fixed source are a cluster of their own and lead no title group.
    ours = F.coalesce(F.col("source_name") == fixed, F.lit(False)) if fixed else F.lit(False)
    grouped = cluster.group_titles(routed.filter(~ours)).unionByName(routed.filter(ours).withColumn("leader", F.col("ord")))
    rolled = cluster.roll_up(grouped, fixed=fixed, fixed_title=fixed_title)
    members = rolled.select("candidate_id", F.explode("source_ids").alias("source_id")).join(readable.select("source_id", "source_type", F.concat_ws(" ", "raw_title", F.coalesce("raw_excerpt", F.lit(""))).alias("said")), "source_id")
    own = members.groupBy("candidate_id").agg(F.collect_list("source_type").alias("types"), F.lower(F.array_join(F.array_sort(F.collect_list("said")), " ")).alias("said"))
    typed = rolled.join(own, "candidate_id").withColumn("type", scoring.classify_type(F.col("said"), F.col("types"), rules)["kind"]).withColumn("type_signals", scoring.type_signals(F.col("said"), F.array_sort("types"), F.col("type"), rules)).withColumn("source_types", F.array_sort(F.array_distinct("types"))).withColumn("tags", scoring.atomic_tags(F.col("said"), F.col("primary_route"), rules) if rules.tags else F.lit(None)).drop("said", "types")
    chosen = select.select_quota(typed.withColumn("title", F.col("canonical_title")).withColumn("route", F.col("primary_route")), quota)
    chosen = select.explained(chosen, wording or select.Wording())
    recalled = outcomes.recall(list(expected), readable, chosen)
    return Structured(scored, chosen, summaries.processing_summary(chosen), outcomes.exclusions(scored), recalled, outcomes.report(source_records, scored, chosen, recalled))


def start(run: Run, source_records: DataFrame, rules: scoring.Rules, quota: select.Quota, tables: str, *, most: int = 10, fixed: str | None = None, fixed_title: str | None = None, provider: enrich.Provider | None = None, cache: DataFrame | None = None, settings: enrich.Settings | None = None, wording: select.Wording | None = None, expected: list[str] = ()) -> DataFrame:
    """Validates, structures, enriches and writes the queue, then waits for a person; returns the queue.

    With a ``provider`` the best of the shortlist, at most ``settings.most_candidates``, get
    a model's type, priority and relevance; its answers are written for the next run's ``cache``.
    """
    spark = source_records.sparkSession
    # A driver that another has overtaken stops here, before it writes anything.
    run.move("running")
    try:
        broken = validate.source_records(source_records)
        if not broken.isEmpty():
            raise ValueError(f"source records break {sorted(r.rule for r in broken.select('rule').distinct().collect())}")
        made = structure(source_records, rules, quota, fixed, fixed_title, wording=wording, expected=expected)
        for name in ("candidates", "exclusions", "recall", "report"):
            where = "structured_report" if name == "report" else name
            getattr(made, name).write.mode("overwrite").parquet(f"{tables}/{run.run_id}/{where}")
        kept = spark.read.parquet(f"{tables}/{run.run_id}/candidates").filter("status = 'selected'")
        if provider is None:
            judged = kept.withColumn("model_priority", F.lit(None).cast("string")).withColumn("relevance", F.lit(0))
        else:
            judged = enriched(kept, source_records, rules, provider, cache, settings or enrich.Settings(), f"{tables}/{run.run_id}/answers")
        queue = select.review_queue(judged, most=most, type_minimums=quota.type_minimums)
        queue.write.mode("overwrite").parquet(f"{tables}/{run.run_id}/queue")
    except Exception:
        run.move("failed")
        raise
    run.move("waiting_for_review")
    return spark.read.parquet(f"{tables}/{run.run_id}/queue")


def enriched(kept: DataFrame, source_records: DataFrame, rules: scoring.Rules, provider: enrich.Provider, cache: DataFrame | None, settings: enrich.Settings, path: str) -> DataFrame:
    """``kept`` with the model's type where it gave one, ``model_priority`` and ``relevance``; answers go to ``path``."""
    asked = kept.orderBy(F.col("score").desc(), "title", "candidate_id").limit(settings.most_candidates)
    wanted = enrich.inputs(asked, joins.members(asked, source_records))
    enrich.enrich(wanted, cache, provider, settings.batch).write.mode("overwrite").parquet(path)
    answers = kept.sparkSession.read.parquet(path)
    analyses = enrich.clamp_sources(answers.select("analysis.*"), asked)
    broken = enrich.violations(analyses, asked, list(rules.types))
    found = sorted({r.rule for r in broken.select("rule").distinct().collect()})
    if found:
        raise ValueError(f"the model's answers break {', '.join(found)}")
    told = analyses.select("candidate_id", F.col("intelligence_type").alias("_type"), F.col("recommended_disposition").alias("model_priority"), F.col("strategy_relevance_score").alias("relevance"), F.col("verification_questions").alias("model_questions"))
    return kept.join(told, "candidate_id", "left").withColumn("type", F.coalesce("_type", "type")).drop("_type")


def publish(run: Run, spark: SparkSession, tables: str, reviews: DataFrame) -> dict[str, DataFrame]:
    """Writes and validates the issue of the run's claims and events: stories, trends, days, their events, the bundle and reports."""
    base = f"{tables}/{run.run_id}"
    claims, events = (spark.read.parquet(f"{base}/{n}") for n in ("claims", "events"))
    days, trends = editorial.timeline(events, category="event_type"), editorial.trends(events)
    made = {
        "stories": editorial.stories(events),
        "days": days,
        "trends": trends,
        "day_members": editorial.day_members(events, days),
        "trend_members": editorial.trend_members(events, trends),
        "issue": editorial.issue(events),
    }
    for name, frame in made.items():
        frame.write.mode("overwrite").parquet(f"{base}/{name}")
    made = {name: spark.read.parquet(f"{base}/{name}") for name in made}
    broken = validate.issue(made["stories"], events, claims, made["days"], made["trends"])
    rules = sorted({r.rule for r in broken.select("rule").distinct().collect()})
    if rules:
        raise ValueError(f"the issue breaks {', '.join(rules)}")
    document = issue_document(run.run_id, events, claims, reviews)
    # Which addresses a review may name is for the gate to say.
    rules = sorted({r.rule for r in validate.documents(document, scheme="").select("rule").distinct().collect()})
    if rules:
        raise ValueError(f"the issue's document breaks {', '.join(rules)}")
    document.select("document").coalesce(1).write.mode("overwrite").text(f"{base}/document", lineSep="\n")
    editorial.bundle(made["stories"], events, claims, reviews).write.mode("overwrite").json(f"{base}/bundle")
    candidates, queue = (spark.read.parquet(f"{base}/{n}") for n in ("candidates", "queue"))
    sizes = {"candidates": candidates, "queued": queue, "reviewed": reviews, "claims": claims, "events": events, "stories": made["stories"]}
    write_text(spark, f"{base}/report", sinks.event_report(review.ranked_events(events), made["days"]))
    write_text(spark, f"{base}/run_report", sinks.run_report(run.run_id, run.history, {name: frame.count() for name, frame in sizes.items()}))
    return made


def issue_document(run_id: str, events: DataFrame, claims: DataFrame, reviews: DataFrame) -> DataFrame:
    """The run's issue as one nested document; an event's review is that of its claims' candidate."""
    keyed = events.withColumn("issue_key", F.lit(run_id))
    cited = events.select("event_id", F.explode("claim_ids").alias("claim_id")).join(claims.select("claim_id", "candidate_id"), "claim_id")
    told = reviews.join(cited.select("event_id", "candidate_id").distinct(), "candidate_id").select("event_id", "url", "decision_reason")
    proof = claims.select("claim_id", "claim_text", "claim_kind", "source_locator", "source_id")
    return editorial.issue_documents(editorial.reader_stories(keyed, proof, told, cite=True))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path, lineSep="\n")


def resume(run: Run, spark: SparkSession, reviews: DataFrame, tables: str, **gate) -> tuple[DataFrame, DataFrame]:
    """(claims, events) of the approved review, with the issue written; a review that breaks a rule leaves the run waiting."""
    if run.state != "waiting_for_review":
        raise ValueError(f"a run in state {run.state} does not wait for a review")
    candidates, queue = (spark.read.parquet(f"{tables}/{run.run_id}/{n}") for n in ("candidates", "queue"))
    claims, events = review.build(reviews, candidates.filter("status = 'selected'"), queue, **gate)
    run.move("running")
    try:
        claims.write.mode("overwrite").parquet(f"{tables}/{run.run_id}/claims")
        events.write.mode("overwrite").parquet(f"{tables}/{run.run_id}/events")
        publish(run, spark, tables, reviews)
    except Exception:
        run.move("failed")
        raise
    run.move("completed")
    return spark.read.parquet(f"{tables}/{run.run_id}/claims"), spark.read.parquet(f"{tables}/{run.run_id}/events")
