"""The issue: stories, trends and a seven-day timeline from approved events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.functions import ids
from siltworks.operators.review import ranked


def trends(events: DataFrame, *, route: str = "primary_route", name: str = "entity_name", order: str = "event_id", top: int = 4) -> DataFrame:
    """The routes with most events, first by name among equals, with count-based heuristic scores.

    A hot route is aggregated in each task; only three names of it are ever kept.
    """
    ranked = events.withColumn("_r", F.row_number().over(Window.partitionBy(route).orderBy(order))).filter("_r <= 3")
    names = ranked.groupBy(route).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", name))), lambda x: x[name]), ", ").alias("names"))
    counts = events.groupBy(route).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), route).limit(top)
    n = F.col("n")
    return counts.join(names, route).select(
        ids.trend_id(F.col(route)).alias("trend_id"),
        F.col(route).alias("route"),
        n.alias("events"),
        "names",
        F.when(n >= 2, "rising").otherwise("unconfirmed").alias("status"),
        F.least(F.lit(95), 74 + 7 * n).cast("int").alias("score"),
        F.concat(F.lit("+"), F.when(6 + 4 * n < 10, F.lpad((6 + 4 * n).cast("string"), 2, "0")).otherwise((6 + 4 * n).cast("string"))).alias("delta"),
        F.least(F.lit(80), 30 + 12 * n).cast("int").alias("maturity"),
        F.least(F.lit(90), 55 + 9 * n).cast("int").alias("impact"),
    )


def timeline(events: DataFrame, *, at: str = "event_at", category: str = "category") -> DataFrame:
    """Seven days to the last event; days without events stay, dates outside go to the ends.

    A day whose events were moved there is labelled with the range of their dates.
    """
    dated = events.withColumn("d", F.to_date(at))
    span = dated.agg(F.greatest(F.max("d"), F.date_add(F.min("d"), 6)).alias("end")).select(F.date_sub("end", 6).alias("start"), "end")
    days = span.select("start", "end", F.explode(F.sequence("start", "end")).alias("day"))
    placed = dated.crossJoin(F.broadcast(span)).withColumn("day", F.least("end", F.greatest("start", "d")))
    firsts = placed.groupBy("day", category).agg(F.min(at).alias("first"), F.count("*").alias("n"), F.min("d").alias("low"), F.max("d").alias("high"))
    per = firsts.groupBy("day").agg(F.sum("n").alias("events"), F.min("low").alias("low"), F.max("high").alias("high"), F.array_sort(F.collect_list(F.struct("first", category))).alias("c"))
    joined = days.join(per, "day", "left")
    label = lambda d: F.date_format(d, "MM.dd")
    moved = (F.col("low") < F.col("start")) | (F.col("high") > F.col("end"))
    return joined.select(
        "day",
        F.when(moved, F.concat(label("low"), F.lit("-"), label("high"))).otherwise(label("day")).alias("label"),
        F.coalesce("events", F.lit(0)).cast("bigint").alias("events"),
        F.coalesce(F.array_join(F.transform("c", lambda x: x[category]), ", "), F.lit("")).alias("categories"),
    )


def trend_members(events: DataFrame, found: DataFrame, *, route: str = "primary_route") -> DataFrame:
    """(trend_id, event_id): the events of each trend, one row each."""
    return events.join(found.select(F.col("route").alias(route), "trend_id"), route).select("trend_id", "event_id")


def day_members(events: DataFrame, days: DataFrame, *, at: str = "event_at") -> DataFrame:
    """(day, event_id, story_id): the events of each day of the timeline, one row each."""
    span = days.agg(F.min("day").alias("start"), F.max("day").alias("end"))
    placed = events.crossJoin(F.broadcast(span)).withColumn("day", F.least("end", F.greatest("start", F.to_date(at))))
    return placed.select("day", "event_id", ids.story_id(F.col("event_id")).alias("story_id"))


def stories(events: DataFrame, *, top: int = 5) -> DataFrame:
    """One story per event: deep dives first, with default score and reading time by rank."""
    part = lambda text, kind: F.struct(text.alias("text"), F.col("claim_ids").alias("claim_ids"), F.lit(kind).alias("statement_type"))
    deep = F.col("rank") < top
    return ranked(events).select(
        ids.story_id(F.col("event_id")).alias("story_id"),
        F.col("event_id").alias("primary_event_id"),
        F.when(deep, "deep_dive").otherwise("brief").alias("article_type"),
        F.col("canonical_title").alias("headline"),
        part(F.col("fact_summary"), "fact").alias("what_happened"),
        part(F.col("limitations"), "judgment").alias("limitations"),
        F.greatest(F.lit(70), 96 - 3 * F.col("rank")).alias("editorial_score"),
        F.when(deep, 5).otherwise(2).alias("reading_time_minutes"),
        F.lit("fact_checked").alias("editorial_status"),
        "rank",
    )


def issue(events: DataFrame) -> DataFrame:
    """One row: the issue's id by the ISO week of its last event, and its size."""
    return events.agg(F.max(F.to_date("event_at")).alias("last_day"), F.count("*").alias("events")).select(ids.issue_id(F.col("last_day")).alias("issue_id"), "last_day", "events")


def bundle(stories: DataFrame, events: DataFrame, claims: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per story with its event, the review behind it and its claims in the event's order.

    An event's claims are one review's, so what is collected for a story is small.
    """
    cited = events.select("event_id", F.posexplode("claim_ids").alias("place", "claim_id")).join(claims, "claim_id")
    claim = F.struct("place", "claim_id", "claim_text", "claim_kind", "source_locator", "source_id")
    own = cited.groupBy("event_id").agg(F.array_sort(F.collect_list(claim)).alias("claims"), F.min("candidate_id").alias("candidate_id"))
    told = reviews.select("candidate_id", F.struct("candidate_id", "url", "verification_status", "decision", "decision_reason").alias("review"))
    whole = events.select("event_id", F.struct(*events.columns).alias("event")).join(own, "event_id", "left").join(told, "candidate_id", "left").drop("candidate_id")
    return stories.join(whole, F.col("primary_event_id") == F.col("event_id"), "left").drop("event_id")


#: Stories that an issue may have; larger sets are no issue and are never gathered.
LEAST_STORIES, MOST_STORIES, TOP = 5, 10, 5


def _keyed(rows: DataFrame, by: str) -> DataFrame:
    """Rows with ``_set``, the key of their set of stories: null is a key too, and in a struct plain equality joins it.

    Windows, groups and joins on this one column share a shuffle.
    """
    return rows if "_set" in rows.columns else rows.withColumn("_set", F.struct(F.col(by).alias("by")))


def _cited(events: DataFrame, claims: DataFrame, kept: list[str]) -> DataFrame:
    """(event_id, _cited): an event's claims in its order, with the columns ``kept``; an event without known claims has no row."""
    named = claims.dropDuplicates(["claim_id"]).select("claim_id", F.struct(*kept).alias("claim"))
    said = events.select("event_id", F.posexplode("claim_ids").alias("place", "claim_id")).join(named, "claim_id")
    return said.groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct("place", "claim"))).alias("_cited"))


def reader_stories(events: DataFrame, claims: DataFrame, reviews: DataFrame, *, tops: DataFrame | None = None, numbers: DataFrame | None = None, labels: list[tuple[str, str]] = (), categories: dict[str, str] | None = None, watch: list[str] = (), by: str = "issue_key", cite: bool = False) -> DataFrame:
    """A story of each event as readers see it: five sections, takeaway, numbers, links.

    ``events`` has ``by``, event_id, canonical_title, priority, event_at, fact_summary,
    limitations, claim_ids, primary_source_id, primary_route and entity_name; ``claims``
    claim_id and claim_text; ``reviews`` event_id, url and decision_reason.  ``tops``
    (``by``, place, event_id) names the long stories, the first five of those that are
    events; without, the first five by rank are.  ``numbers`` has event_id, place, label,
    value and claim_id; ``labels`` pairs a part of a url with the label of its link.

    A null or blank text falls back: the deck and the section under the hood to the fact,
    the reason to the fact; an event that two reviews name takes the first by url.

    With ``cite`` a story's row also keeps its event's route and whole claims, so that
    ``issue_documents`` needs neither table again.
    """
    place = F.when(F.col("priority") == "priority.p0", 0).when(F.col("priority") == "priority.p1", 1).when(F.col("priority") == "priority.p2", 2).otherwise(9)
    ends = _cited(events, claims, claims.columns) if cite else _cited(events, claims.select("claim_id", "claim_text"), ["claim_text"])
    first, last = [F.get("_cited", at)["claim"]["claim_text"] for at in (F.lit(0), F.size("_cited") - 1)]
    if not cite:
        ends = ends.select("event_id", first.alias("_first"), last.alias("_last"))
        first, last = F.col("_first"), F.col("_last")
    told = reviews.groupBy("event_id").agg(F.min_by(F.struct("url", "decision_reason"), "url").alias("_review"))
    base = _keyed(events, by).join(ends, "event_id", "left").join(told, "event_id", "left")
    if numbers is None:
        base = base.withColumn("_numbers", F.lit(None).cast("array<struct<place:int,label:string,value:string,claim_id:string>>"))
    else:
        base = base.join(numbers.groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct(F.col("place").cast("int").alias("place"), "label", "value", "claim_id"))).alias("_numbers")), "event_id", "left")
    # What is found by event comes first; then a story's row moves once, to its set, for every order in it.
    mine = Window.partitionBy("_set")
    if tops is not None:
        # Named events stand beside the events as rows, so that rows of one event see the least place of it.
        named = _keyed(tops, by).filter("event_id is not null").select("_set", "event_id", F.col("place").alias("_at"), F.lit(False).alias("_told"))
        base = base.withColumn("_told", F.lit(True)).unionByName(named, allowMissingColumns=True)
        base = base.withColumn("_at", F.min("_at").over(mine.orderBy("event_id").rangeBetween(Window.currentRow, Window.currentRow))).filter("_told")
    base = base.withColumn("rank", F.row_number().over(mine.orderBy(place, "event_at", "event_id")) - 1)
    if tops is None:
        base = base.withColumn("_top", F.when(F.col("rank") < TOP, F.col("rank")))
    else:
        order = F.row_number().over(mine.orderBy(F.col("_at").asc_nulls_last(), "rank")) - 1
        base = base.withColumn("_top", F.when(F.col("_at").isNotNull() & (order < TOP), order))
    whole = lambda c, other: F.when(F.btrim(F.coalesce(c, F.lit(""))) != "", c).otherwise(other)
    section = lambda text, kind: F.struct(text.alias("text"), F.col("claim_ids").alias("claim_ids"), F.lit(kind).alias("statement_type"))
    fact, deep = F.col("fact_summary"), F.col("_top").isNotNull()
    reason, url = whole(F.col("_review.decision_reason"), fact), F.col("_review.url")
    label = F.lit("Original source")
    for part, name in reversed(list(labels)):
        label = F.when(F.contains(url, F.lit(part)), name).otherwise(label)
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in categories.items() for x in pair]), F.col("primary_route")), F.lit("general")) if categories else F.coalesce("primary_route", F.lit("general"))
    take = F.concat(F.lit("Worth following: what "), F.coalesce("entity_name", F.lit("the source")), F.lit(" shows in use, at what cost and for which work."))
    return base.select(
        by,
        ids.story_id(F.col("event_id")).alias("story_id"),
        F.col("event_id").alias("primary_event_id"),
        F.when(deep, "deep_dive").otherwise("brief").alias("article_type"),
        F.col("canonical_title").alias("headline"),
        whole(first, fact).alias("dek"),
        reason.alias("one_line_takeaway"),
        kind.alias("category"),
        section(fact, "fact").alias("what_happened"),
        section(reason, "judgment").alias("why_it_matters"),
        F.when(deep, section(take, "judgment")).alias("our_take"),
        section(whole(last, fact), "fact").alias("under_the_hood"),
        section(F.col("limitations"), "judgment").alias("limitations"),
        F.array(*[F.lit(w) for w in watch]).cast("array<string>").alias("watch_next"),
        F.transform(F.coalesce("_numbers", F.array().cast("array<struct<place:int,label:string,value:string,claim_id:string>>")), lambda x: F.struct(x["label"].alias("label"), x["value"].alias("value"), x["claim_id"].alias("claim_id"))).alias("key_numbers"),
        F.when(url.isNotNull(), F.array(F.struct(F.col("primary_source_id").alias("source_id"), label.alias("label"), url.alias("url"), F.lit("primary").alias("role")))).otherwise(F.array().cast("array<struct<source_id:string,label:string,url:string,role:string>>")).alias("source_links"),
        F.array_distinct(F.array_compact(F.array(kind, F.col("entity_name")))).alias("primary_tags"),
        F.greatest(F.lit(70), 96 - 3 * F.col("rank")).alias("editorial_score"),
        F.when(deep, 5).otherwise(2).alias("reading_time_minutes"),
        F.lit("fact_checked").alias("editorial_status"),
        F.col("event_at").alias("published_at"),
        "rank",
        F.col("_top").alias("top_place"),
        "_set",
        *([F.struct("primary_route").alias("_routed"), "_cited"] if cite else []),
    )


def issue_documents(stories: DataFrame, events: DataFrame | None = None, claims: DataFrame | None = None, *, by: str = "issue_key") -> DataFrame:
    """(``by``, document): each issue as one nested JSON text, from ordered member tables.

    Only sets of ``LEAST_STORIES`` to ``MOST_STORIES`` stories are an issue, so a document is
    small; others are left to ``validate.issue_sizes``.  Days, trends and claims are those
    of the issue's own events; a day outside the last seven goes to the nearer end.

    Stories told with ``cite`` hold what their events name; for others, ``events`` and ``claims`` are joined.
    """
    counted = _keyed(stories, by).withColumn("_n", F.count("*").over(Window.partitionBy("_set")))
    own = counted.filter(F.col("_n").between(LEAST_STORIES, MOST_STORIES)).drop("_n")
    told = [c for c in own.columns if c not in (by, "rank", "top_place", "_set", "_routed", "_cited")]
    listed = lambda x: F.array_sort(F.collect_list(x))
    parts = [listed(F.struct("rank", "top_place", F.struct(*told).alias("story"))).alias("s"), F.to_date(F.min("published_at")).alias("low"), F.to_date(F.max("published_at")).alias("high")]
    # Events of a set, with the route and the claims of each.
    named = listed(F.when(F.col("primary_event_id").isNotNull(), F.struct("rank", F.col("primary_event_id").alias("event_id"), "_routed", "_cited"))).alias("e")
    if events is None:
        whole = own.groupBy("_set").agg(*parts, named)
    else:
        known = events.select(F.col("event_id"), F.struct("primary_route").alias("_routed")).join(_cited(events, claims, claims.columns), "event_id", "left").withColumnRenamed("event_id", "primary_event_id")
        mine = own.select("_set", "rank", "primary_event_id").join(known, "primary_event_id")
        whole = own.groupBy("_set").agg(*parts).join(mine.groupBy("_set").agg(named), "_set", "left")
    tops = F.transform(F.array_sort(F.transform(F.filter("s", lambda x: x["top_place"].isNotNull()), lambda x: F.struct(x["top_place"].alias("p"), x["story"]["story_id"].alias("i")))), lambda x: x["i"])
    briefs = F.transform(F.filter("s", lambda x: x["top_place"].isNull()), lambda x: x["story"]["story_id"])
    end = F.greatest(F.col("high"), F.date_add("low", 6))
    days = F.transform(
        F.sequence(F.date_sub(end, 6), end),
        lambda day: F.struct(
            day.cast("string").alias("day"),
            F.transform(F.filter("s", lambda x: F.least(end, F.greatest(F.date_sub(end, 6), F.to_date(x["story"]["published_at"]))) == day), lambda x: x["story"]["story_id"]).alias("story_ids"),
        ),
    )
    route = lambda x: x["_routed"]["primary_route"]
    of_route = lambda r: F.filter("e", lambda x: route(x).eqNullSafe(r))
    routes = F.array_sort(F.transform(F.array_distinct(F.transform("e", route)), lambda r: F.struct((-F.size(of_route(r))).alias("n"), r.alias("route"))))
    trend = lambda t: F.struct(ids.trend_id(F.coalesce(t["route"], F.lit(""))).alias("trend_id"), t["route"].alias("route"), (-t["n"]).alias("events"), F.transform(of_route(t["route"]), lambda x: x["event_id"]).alias("event_ids"))
    radar = F.when(F.size("e") > 0, F.transform(F.slice(routes, 1, 4), trend)).alias("trend_radar")
    proof = F.flatten(F.filter(F.transform("e", lambda x: F.transform(x["_cited"], lambda c: c["claim"])), lambda x: x.isNotNull()))
    proof = F.when(F.size(proof) > 0, proof).alias("evidence_claims")
    size = F.size("s")
    issue = F.struct(
        ids.issue_id(F.col("high")).alias("issue_id"),
        F.col("low").cast("string").alias("period_start"),
        F.col("high").cast("string").alias("period_end"),
        F.get(tops, F.lit(0)).alias("lead_story_id"),
        tops.alias("top_story_ids"),
        briefs.alias("brief_story_ids"),
        size.alias("story_count"),
        F.size(tops).alias("deep_dive_count"),
        F.size(briefs).alias("brief_count"),
    )
    document = F.struct(issue.alias("issue"), F.struct(days.alias("timeline_days"), radar).alias("presentation"), F.transform("s", lambda x: x["story"]).alias("editorial_stories"), proof)
    return whole.select(F.col("_set.by").alias(by), F.to_json(document).alias("document"))
