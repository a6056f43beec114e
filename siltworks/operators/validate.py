"""Contracts as violation rows (rule, key); an empty frame is a pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.records import SCHEMA_VERSION, SOURCE_RECORD
from siltworks.functions.urls import valid_url
from siltworks.operators.joins import orphans


def _rows(rule: str, df: DataFrame, key: str) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _repeated(df: DataFrame, key: str, rule: str) -> DataFrame:
    return _rows(rule, df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1"), key)


def row_rules(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """Row rules in one scan: each rule holds where its column is true; null breaks it."""
    broken = F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()])
    return df.select(F.explode(F.filter(broken, lambda x: x.isNotNull())).alias("rule"), F.col(key).cast("string").alias("key"))


def source_records(records: DataFrame, expected: int | None = None) -> DataFrame:
    missing = [f for f in SOURCE_RECORD if f not in records.columns]
    if missing:
        return records.sparkSession.createDataFrame([("missing_field", f) for f in missing], "rule string, key string")
    has_reason = F.coalesce(F.col("failure_reason"), F.lit("")) != ""
    status = F.col("access_status")
    parts = [
        row_rules(
            records,
            "source_id",
            {
                "contract": (F.col("schema_version") == SCHEMA_VERSION) & (F.col("record_type") == "source_record"),
                "id_prefix": F.col("source_id").startswith("src_"),
                "source_url": valid_url(F.col("source_url")),
                "canonical_url": valid_url(F.col("canonical_url")),
                "collected_at": F.col("collected_at").isNotNull(),
                "failure_needs_reason": ~F.coalesce(status.isin("failed", "blocked"), F.lit(False)) | has_reason,
                "success_has_no_reason": (F.coalesce(status, F.lit("")) != "success") | ~has_reason,
            },
        ),
        _repeated(records, "source_id", "duplicate_id"),
        _repeated(records, "canonical_url", "duplicate_url"),
    ]
    if expected is not None:
        parts.append(records.agg(F.count("*").alias("n")).filter(F.col("n") != expected).select(F.lit("count").alias("rule"), F.col("n").cast("string").alias("key")))
    return _all(parts)


def shortlist(selected: DataFrame, overflow: DataFrame, *, least: int = 12, most: int = 30, types: list[str], type_caps: dict[str, int], route_minimums: dict[str, int], recall: DataFrame | None = None, fixed_title: str | None = None, collapsed: int = 0) -> DataFrame:
    """Size, ids, reasons, questions, status, types, retention of available types, attainable routes and recall.

    Questions and status are held where ``selected`` has them.  With ``fixed_title``, the
    watched source's records are one candidate, made by the rule of its cluster, and
    ``collapsed``, the members that the run's report counts as collapsed into it, agrees.
    """
    spark = selected.sparkSession
    told = {}
    if "verification_questions" in selected.columns:
        told["questions"] = F.size("verification_questions") > 0
    if "status" in selected.columns:
        told["status"] = F.col("status") == "selected"
    parts = [
        selected.agg(F.count("*").alias("n")).filter(~F.col("n").between(least, most)).select(F.lit("size").alias("rule"), F.col("n").cast("string").alias("key")),
        _repeated(selected, "candidate_id", "duplicate_id"),
        row_rules(selected, "candidate_id", {"reason": F.coalesce(F.col("reason"), F.lit("")) != "", "known_type": F.col("type").isin(*types)} | told),
    ]
    if fixed_title is not None:
        ours = selected.filter(F.col("canonical_title") == fixed_title).agg(F.count("*").alias("n"), F.min("method").alias("method"), F.coalesce(F.sum("source_count"), F.lit(0)).alias("members"))
        whole = (F.col("n") == 1) & (F.col("method") == "fixed_cluster") & (F.col("members") - 1 == collapsed)
        broken = ours.filter(((F.col("n") > 0) | F.lit(collapsed > 0)) & ~F.coalesce(whole, F.lit(False)))
        parts.append(broken.select(F.lit("fixed_cluster").alias("rule"), F.col("n").cast("string").alias("key")))
    per_type = selected.groupBy("type").agg(F.count("*").alias("n"))
    if type_caps:
        caps = spark.createDataFrame(list(type_caps.items()), "type string, cap int")
        parts.append(_rows("type_cap", per_type.join(caps, "type").filter("n > cap"), "type"))
    parts.append(_rows("type_retained", overflow.select("type").distinct().join(per_type, "type", "left_anti"), "type"))
    if route_minimums:
        wanted = spark.createDataFrame(list(route_minimums.items()), "route string, least int")
        have = selected.groupBy("route").agg(F.count("*").alias("n"))
        available = selected.select("route").unionByName(overflow.select("route")).groupBy("route").agg(F.count("*").alias("a"))
        short = wanted.join(have, "route", "left").join(available, "route", "left").filter(F.coalesce("n", F.lit(0)) < F.least("least", F.coalesce("a", F.lit(0))))
        parts.append(_rows("route_minimum", short, "route"))
    if recall is not None:
        parts.append(_rows("recall", recall.filter("present and not selected"), recall.columns[0]))
    return _all(parts)


def verified(events: DataFrame, claims: DataFrame, sources: DataFrame, *, least: int = 5, most: int = 10) -> DataFrame:
    cited = events.select("event_id", F.explode("claim_ids").alias("claim_id"))
    return _all(
        [
            events.agg(F.count("*").alias("n")).filter(~F.col("n").between(least, most)).select(F.lit("size").alias("rule"), F.col("n").cast("string").alias("key")),
            _repeated(events, "event_id", "duplicate_id"),
            _rows("unknown_claim", orphans(cited, claims, "claim_id", "claim_id"), "event_id"),
            _rows("unknown_source", orphans(events, sources, "primary_source_id", "source_id"), "event_id"),
            row_rules(events, "event_id", {"primary_listed": F.array_contains("source_ids", F.col("primary_source_id")), "limitations": F.col("limitations").isNotNull()}),
        ]
    )


def issue(stories: DataFrame, events: DataFrame, claims: DataFrame, days: DataFrame, trends: DataFrame) -> DataFrame:
    size = stories.agg(F.count("*").alias("n"), F.count_if(F.col("article_type") == "deep_dive").alias("deep"))
    used = stories.select("story_id", F.explode(F.array_union("what_happened.claim_ids", "limitations.claim_ids")).alias("claim_id"))
    count = lambda df, rule, low, high: df.agg(F.count("*").alias("n")).filter(~F.col("n").between(low, high)).select(F.lit(rule).alias("rule"), F.col("n").cast("string").alias("key"))
    return _all(
        [
            size.filter(~F.col("n").between(5, 10)).select(F.lit("size").alias("rule"), F.col("n").cast("string").alias("key")),
            size.filter(F.col("deep") != F.least(F.lit(5), "n")).select(F.lit("deep_dives").alias("rule"), F.col("deep").cast("string").alias("key")),
            _repeated(stories, "story_id", "duplicate_id"),
            _rows("event_without_story", events.join(stories.select(F.col("primary_event_id").alias("event_id")), "event_id", "left_anti"), "event_id"),
            _rows("unknown_claim", orphans(used, claims, "claim_id", "claim_id"), "story_id"),
            row_rules(stories, "story_id", {"fact": F.col("what_happened.statement_type") == "fact", "checked": F.col("editorial_status") == "fact_checked", "claims": F.size("what_happened.claim_ids") > 0}),
            count(days, "seven_days", 7, 7),
            count(trends, "trends", 1, 4),
        ]
    )


def issue_sizes(stories: DataFrame, *, by: str = "issue_key", least: int = 5, most: int = 10) -> DataFrame:
    """(rule, key): the sets of stories that are too few or too many for an issue."""
    return _rows("size", stories.groupBy(by).agg(F.count("*").alias("n")).filter(~F.col("n").between(least, most)), by)


#: The sections that every story has, and what they state.
SECTIONS = {"what_happened": "fact", "why_it_matters": "judgment", "under_the_hood": "fact", "limitations": "judgment"}


def documents(issues: DataFrame, *, by: str = "issue_key", scheme: str = "https://") -> DataFrame:
    """(rule, key, place) of nested issue documents: every id used anywhere exists once.

    ``issues`` has ``by`` and the JSON text ``document``, read as VARIANT by path; ``place``
    is the story, trend or day at fault, or empty.  Links begin with ``scheme``.  A text that is no JSON object breaks not_json.
    """
    v = F.try_parse_json("document")
    # The parser stops behind the first value, so what the text ends with is looked at as well.
    ends = F.rtrim("document").endswith("}")
    doc = issues.select(F.col(by).cast("string").alias("key"), v.alias("v"), F.coalesce(F.schema_of_variant(v).startswith("OBJECT<") & ends, F.lit(False)).alias("ok"))
    texts = lambda path: F.coalesce(F.try_variant_get("v", path, "array<string>"), F.array().cast("array<string>"))
    parts = lambda path: F.coalesce(F.try_variant_get("v", path, "array<variant>"), F.array().cast("array<variant>"))
    of = lambda item, path, kind="string": F.try_variant_get(item, path, kind)
    strings = lambda item, path: F.coalesce(of(item, path, "array<string>"), F.array().cast("array<string>"))
    read = doc.select("key", "v", "ok", parts("$.editorial_stories").alias("stories"), parts("$.evidence_claims").alias("proof"), parts("$.presentation.timeline_days").alias("days"), parts("$.presentation.trend_radar").alias("trends"), texts("$.issue.top_story_ids").alias("tops"), texts("$.issue.brief_story_ids").alias("briefs"))
    read = read.select(
        "*",
        F.transform("stories", lambda s: of(s, "$.story_id")).alias("story_ids"),
        F.transform("stories", lambda s: of(s, "$.primary_event_id")).alias("event_ids"),
        F.transform("proof", lambda c: of(c, "$.claim_id")).alias("claim_ids"),
        F.flatten(F.transform("days", lambda d: strings(d, "$.story_ids"))).alias("day_ids"),
    )
    n, deep = F.size("stories"), F.size(F.filter("stories", lambda s: of(s, "$.article_type") == "deep_dive"))
    known = lambda ids_, all_: F.size(F.array_except(ids_, all_)) == 0
    once = lambda ids_: (F.size(F.array_distinct(ids_)) == F.size(ids_)) & ~F.exists(ids_, lambda x: x.isNull())
    same = lambda a, b: (F.size(a) == F.size(b)) & known(a, b) & known(b, a)
    whole = {
        "size": n.between(5, 10),
        "deep_dives": deep == F.least(F.lit(5), n),
        "duplicate_story": once(F.col("story_ids")),
        "duplicate_event": once(F.col("event_ids")),
        "duplicate_claim": once(F.col("claim_ids")),
        "top_size": F.size("tops") == F.least(F.lit(5), n),
        "lists": same(F.concat("tops", "briefs"), F.col("story_ids")),
        "lead": F.coalesce(of("v", "$.issue.lead_story_id") == F.get("tops", F.lit(0)), F.lit(False)),
        "seven_days": F.size("days") == 7,
        "timeline": same(F.col("day_ids"), F.col("story_ids")),
        "trends": F.size("trends").between(1, 4),
    }

    def faults(item, place, rules):
        return [F.struct(F.lit(rule).alias("rule"), F.when(~F.coalesce(good, F.lit(False)), F.coalesce(place, F.lit(""))).alias("place")) for rule, good in rules.items()]

    def story(s):
        rules = {"status": of(s, "$.editorial_status") == "fact_checked", "links": (F.size(F.coalesce(of(s, "$.source_links", "array<variant>"), F.array().cast("array<variant>"))) > 0) & F.forall(F.coalesce(of(s, "$.source_links", "array<variant>"), F.array().cast("array<variant>")), lambda x: F.coalesce(of(x, "$.url").startswith(scheme), F.lit(False)))}
        for name, kind in SECTIONS.items():
            cited = strings(s, f"$.{name}.claim_ids")
            rules |= {f"{name}_kind": of(s, f"$.{name}.statement_type") == kind, f"{name}_claims": (F.size(cited) > 0) & known(cited, F.col("claim_ids"))}
        rules["numbers"] = F.forall(F.coalesce(of(s, "$.key_numbers", "array<variant>"), F.array().cast("array<variant>")), lambda x: F.coalesce(F.array_contains("claim_ids", of(x, "$.claim_id")), F.lit(False)))
        rules["listed"] = F.array_contains(F.when(of(s, "$.article_type") == "deep_dive", F.col("tops")).otherwise(F.col("briefs")), of(s, "$.story_id"))
        return F.array(*faults(s, of(s, "$.story_id"), rules))

    every = F.concat(
        F.array(*faults(None, F.lit(""), whole)),
        F.flatten(F.transform("stories", story)),
        F.flatten(F.transform("trends", lambda t: F.array(*faults(t, of(t, "$.trend_id"), {"trend_events": known(strings(t, "$.event_ids"), F.col("event_ids"))})))),
    )
    broken = F.when(F.col("ok"), F.filter(every, lambda x: x["place"].isNotNull())).otherwise(F.array(F.struct(F.lit("not_json").alias("rule"), F.lit("").alias("place"))))
    return read.select("key", F.explode(broken).alias("x")).select("x.rule", "key", "x.place")
