"""The human review gate: a template, rule violations as rows, and the verified tables.

Nothing passes without an approved review.  ``violations`` unions one frame per rule;
``build`` refuses to make events while it has rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.functions import ids

# Fixed values of the review's contract.
DECISIONS = ("include", "watch", "exclude")
EVENT_FIELDS = ("event_id", "canonical_title", "event_type", "primary_route", "priority", "confidence", "entity_name", "tags")
LEAST_EVENTS, MOST_EVENTS = 5, 10
PRIORITY_RANK = {"priority.p0": 0, "priority.p1": 1, "priority.p2": 2}

REVIEW = (
    "candidate_id string, source_id string, title string, url string, published_at timestamp, verification_status string, "
    "claims array<struct<text:string,kind:string,locator:string,quote_excerpt:string>>, limitation string, decision string, decision_reason string, "
    "event struct<event_id:string,canonical_title:string,event_type:string,primary_route:string,priority:string,confidence:string,entity_name:string,tags:array<string>>"
)


def template(queue: DataFrame, sources: DataFrame) -> DataFrame:
    """One pending review per queued candidate; a candidate without its primary source is an error."""
    src = sources.select(F.col("source_id").alias("primary_source_id"), F.col("canonical_url").alias("url"), F.lit(True).alias("_known"))
    lost = F.raise_error(F.concat(F.lit("no source for candidate "), F.col("candidate_id"))).cast("boolean")
    return queue.join(src, "primary_source_id", "left").filter(F.coalesce("_known", lost)).select(
        "candidate_id",
        F.col("primary_source_id").alias("source_id"),
        F.col("canonical_title").alias("title"),
        "url",
        "published_at",
        F.lit("pending").alias("verification_status"),
        F.lit("").alias("limitation"),
        F.lit("pending").alias("decision"),
        F.lit("").alias("decision_reason"),
        F.array_union(F.coalesce("verification_questions", F.array().cast("array<string>")), F.coalesce("model_questions", F.array().cast("array<string>"))).alias("verification_questions"),
    )


def violations(reviews: DataFrame, candidates: DataFrame, queued: DataFrame, *, status: str, verified_at=None, verified_by=None) -> DataFrame:
    """(rule, key) of everything that keeps the review from being applied."""
    spark = reviews.sparkSession
    head = [("approved", None)] if status != "approved" else []
    head += [("verifier", None)] if not (verified_at and verified_by) else []
    out = spark.createDataFrame(head, "rule string, key string")
    blank = lambda c: F.coalesce(F.btrim(c), F.lit("")) == ""

    def rows(rule: str, df: DataFrame, key: str = "candidate_id") -> DataFrame:
        return df.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"))

    none = F.coalesce(F.size("claims"), F.lit(0)) <= 0
    incomplete = F.exists(F.coalesce("claims", F.array().cast(reviews.schema["claims"].dataType)), lambda c: blank(c["text"]) | blank(c["kind"]) | blank(c["locator"]))
    included = reviews.filter("decision = 'include'")
    lacking = F.lit(False)
    for f in EVENT_FIELDS:
        lacking = lacking | F.col(f"event.{f}").isNull()
    parts = [
        rows("duplicate_candidate", reviews.groupBy("candidate_id").count().filter("count > 1")),
        rows("unknown_candidate", reviews.join(candidates.select("candidate_id").distinct(), "candidate_id", "left_anti")),
        rows("missing_queued", queued.select("candidate_id").distinct().join(reviews, "candidate_id", "left_anti")),
        rows("source_unverified", reviews.filter(F.coalesce(F.col("verification_status"), F.lit("")) != "verified_primary")),
        rows("decision", reviews.filter(~F.coalesce(F.col("decision").isin(*DECISIONS), F.lit(False)))),
        rows("decision_reason", reviews.filter(blank(F.col("decision_reason")))),
        rows("limitation", reviews.filter(blank(F.col("limitation")))),
        rows("no_claims", reviews.filter(none)),
        rows("claim_fields", reviews.filter(incomplete)),
        rows("event_fields", included.filter(lacking)),
        rows("duplicate_event", included.filter(F.col("event.event_id").isNotNull()).groupBy(F.col("event.event_id").alias("event_id")).count().filter("count > 1"), "event_id"),
        included.agg(F.count("*").alias("n")).filter(~F.col("n").between(LEAST_EVENTS, MOST_EVENTS)).select(F.lit("event_count").alias("rule"), F.col("n").cast("string").alias("key")),
    ]
    for p in parts:
        out = out.unionByName(p)
    return out


def claims(reviews: DataFrame) -> DataFrame:
    """One row per claim, numbered from 1 in its review."""
    each = reviews.select("candidate_id", "source_id", F.posexplode("claims").alias("i", "c"))
    return each.select(ids.claim_id(F.col("candidate_id"), F.col("i") + 1).alias("claim_id"), "candidate_id", "source_id", F.col("c.text").alias("claim_text"), F.col("c.kind").alias("claim_kind"), F.col("c.locator").alias("source_locator"), F.col("c.quote_excerpt").alias("quote_excerpt"))


def events(reviews: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row per included review: facts in claim order, sources with the verified one among them."""
    text = F.transform("claims", lambda c: F.regexp_replace(c["text"], "[。；.; ]+$", ""))
    number = F.transform(F.sequence(F.lit(1), F.size("claims")), lambda i: ids.claim_id(F.col("candidate_id"), i))
    src = F.when(F.array_contains("source_ids", F.col("source_id")), F.col("source_ids")).otherwise(F.concat(F.array("source_id"), "source_ids"))
    joined = reviews.filter("decision = 'include'").join(candidates.select("candidate_id", "source_ids", "track"), "candidate_id")
    return joined.select(
        F.col("event.event_id").alias("event_id"),
        F.col("event.event_type").alias("event_type"),
        F.col("event.canonical_title").alias("canonical_title"),
        F.col("published_at").alias("event_at"),
        F.col("event.entity_name").alias("entity_name"),
        F.col("event.primary_route").alias("primary_route"),
        F.col("event.priority").alias("priority"),
        F.col("event.confidence").alias("confidence"),
        src.alias("source_ids"),
        F.col("source_id").alias("primary_source_id"),
        number.alias("claim_ids"),
        F.concat(F.array_join(text, "; "), F.lit(".")).alias("fact_summary"),
        F.col("limitation").alias("limitations"),
        "track",
        F.size(src).alias("source_count"),
        ids.dedupe_key(F.col("event.entity_name"), F.col("event.event_type"), F.date_format("published_at", "yyyy-MM-dd")).alias("dedupe_key"),
    )


def priority_rank(column: str = "priority"):
    rank = F.lit(9)
    for name, value in PRIORITY_RANK.items():
        rank = F.when(F.col(column) == name, value).otherwise(rank)
    return rank


def ranked(events: DataFrame) -> DataFrame:
    """``events`` with ``rank`` from 0 by priority, time and id.

    Days are counted, the few counts are added up, and rows are ranked inside their day,
    so no task sees more than a day's events of one priority.
    """
    dated = events.withColumn("_p", priority_rank()).withColumn("_d", F.to_date("event_at"))
    per = dated.groupBy("_p", "_d").agg(F.count("*").alias("n"))
    base = per.select("_p", "_d", (F.sum("n").over(Window.orderBy("_p", "_d")) - F.col("n")).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_p", "_d").orderBy("event_at", "event_id")) - 1
    joined = dated.withColumn("_in", inside).alias("e").join(base.alias("b"), F.col("e._p").eqNullSafe(F.col("b._p")) & F.col("e._d").eqNullSafe(F.col("b._d")))
    return joined.select(*[F.col(f"e.`{c}`") for c in events.columns], (F.col("_base") + F.col("_in")).alias("rank"))


def ranked_events(found: DataFrame, top: int = 5) -> DataFrame:
    """Events with their rank from 1 by priority, then the oldest, and whether they are among the first."""
    return ranked(found).withColumn("rank", F.col("rank") + 1).withColumn("is_top", F.col("rank") <= top)


def independent_publishers(found: DataFrame, sources: DataFrame) -> DataFrame:
    """Distinct publishers behind each event; ids alone do not make sources independent."""
    each = found.select("event_id", F.explode("source_ids").alias("source_id")).join(sources.select("source_id", "publisher"), "source_id")
    return each.groupBy("event_id").agg(F.count_distinct("publisher").alias("publishers"))


def build(reviews: DataFrame, candidates: DataFrame, queued: DataFrame, **gate) -> tuple[DataFrame, DataFrame]:
    """(claims, events) of an approved review; an error names the rules that it breaks."""
    broken = violations(reviews, candidates, queued, **gate)
    rules = sorted({r.rule for r in broken.select("rule").distinct().collect()})
    if rules:
        raise ValueError(f"the review breaks {', '.join(rules)}")
    return claims(reviews), events(reviews, candidates)


def apply_selection(reviews: DataFrame, include: list[str], watch: list[str]) -> DataFrame:
    """Decisions by lists that must be disjoint and together name every review exactly."""
    spark = reviews.sparkSession
    if set(include) & set(watch):
        raise ValueError("a candidate is both included and watched")
    if len({*include, *watch}) < len(include) + len(watch):
        raise ValueError("a candidate is listed twice")
    chosen = spark.createDataFrame([(x, "include") for x in include] + [(x, "watch") for x in watch], "candidate_id string, _decision string")
    odd = reviews.select("candidate_id").join(chosen, "candidate_id", "full_outer").join(reviews.select("candidate_id").withColumn("_in", F.lit(True)), "candidate_id", "left").filter("_decision is null or _in is null")
    if not odd.isEmpty():
        raise ValueError("the selection does not match the reviews")
    return reviews.join(chosen, "candidate_id").withColumn("decision", F.col("_decision")).drop("_decision")
