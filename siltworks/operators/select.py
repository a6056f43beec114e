"""Quota-balanced shortlist: six phases over route and type counters.

The phases depend on each other's counts, so they run in order over few rows.  Of the
candidates of one (type, route) only the best ``target + minimum`` can ever be picked:
caps and quotas see nothing else of a candidate, so a worse one is picked only after a
better one of its pair.  Spark ranks and prunes by pair; what is left is bounded by
the numbers of types and routes, however many candidates there are.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.operators.checkpoints import with_checkpoints

PINNED = "pinned"


@dataclass(frozen=True)
class Quota:
    target: int = 25
    minimum: int = 12
    minimum_score: int = 7
    type_minimums: dict[str, int] = field(default_factory=dict)
    type_caps: dict[str, int] = field(default_factory=dict)
    route_minimums: dict[str, int] = field(default_factory=dict)
    route_caps: dict[str, int] = field(default_factory=dict)
    pinned_titles: tuple[str, ...] = ()
    first_priority: int = 16


def fill_quota(rows: list[dict], quota: Quota, pinned: list[tuple[str, str]] = ()) -> dict[str, str]:
    """candidate_id -> reason; ``rows`` are best first, ``pinned`` the (type, route) of rows taken already."""
    types, routes = Counter(t for t, _ in pinned), Counter(r for _, r in pinned)
    chosen: dict[str, dict] = {}
    reason: dict[str, str] = {}
    size = lambda: len(chosen) + len(pinned)

    def open_type(c: dict) -> bool:
        return types[c["type"]] < quota.type_caps.get(c["type"], quota.target)

    def open_route(c: dict) -> bool:
        return routes[c["route"]] < quota.route_caps.get(c["route"], quota.target)

    def take(why: str, want, may) -> None:
        for c in rows:
            if not want(c):
                return
            if c["id"] not in chosen and may(c):
                chosen[c["id"]], reason[c["id"]] = c, why
                types[c["type"]] += 1
                routes[c["route"]] += 1

    for kind, least in quota.type_minimums.items():
        take("type_minimum", lambda c, k=kind, n=least: types[k] < n and size() < quota.target, lambda c, k=kind: c["type"] == k and open_type(c))
    for route, least in quota.route_minimums.items():
        take("route_minimum", lambda c, r=route, n=least: routes[r] < n and size() < quota.target, lambda c, r=route: c["route"] == r and open_route(c))
    take("balanced", lambda c: size() < quota.target, lambda c: open_type(c) and open_route(c))
    take("minimum_count", lambda c: size() < quota.minimum, open_route)
    for kind, cap in quota.type_caps.items():
        for c in sorted((c for c in chosen.values() if c["type"] == kind), key=lambda c: (c["score"], c["title"], c["id"])):
            if types[kind] <= cap:
                break
            if routes[c["route"]] > quota.route_minimums.get(c["route"], 0):
                del chosen[c["id"]]
                types[kind] -= 1
                routes[c["route"]] -= 1
    return {k: reason[k] for k in chosen}


def priority(reason: Column, track: Column, score: Column, first: int) -> Column:
    return F.when((reason == PINNED) | (track == "track.fixed") | (score >= first), "priority.p1").otherwise("priority.p2")


def select_quota(candidates: DataFrame, quota: Quota) -> DataFrame:
    """``candidates`` (candidate_id, title, type, route, score, track) with status, reason and priority.

    status: selected, overflow, below_threshold or unrouted.  Candidates are written once,
    so that ranking, pins and the result do not score them again.
    """
    with_checkpoints(candidates.sparkSession)
    candidates = candidates.checkpoint()
    eligible = candidates.filter(F.col("route").isNotNull() & (F.col("score") >= quota.minimum_score))
    fixed = F.coalesce(F.col("title").isin(*quota.pinned_titles), F.lit(False)) if quota.pinned_titles else F.lit(False)
    counts = eligible.filter(fixed).groupBy("type", "route").agg(F.count("*").alias("n")).collect() if quota.pinned_titles else []
    pinned = [(r.type, r.route) for r in counts for _ in range(min(r.n, quota.target * 4))]
    rank = F.row_number().over(Window.partitionBy("type", "route").orderBy(F.col("score").desc(), "title", "candidate_id"))
    few = eligible.filter(~fixed).withColumn("_r", rank).filter(F.col("_r") <= quota.target + quota.minimum)
    rows = [{"id": r.candidate_id, "title": r.title or "", "type": r.type, "route": r.route, "score": r.score} for r in few.select("candidate_id", "title", "type", "route", "score").collect()]
    rows.sort(key=lambda c: (-c["score"], c["title"], c["id"]))
    picked = fill_quota(rows, quota, pinned)
    spark = candidates.sparkSession
    chosen = spark.createDataFrame(list(picked.items()), "candidate_id string, _why string")
    # The chosen are at most the target and the minimum.
    out = candidates.join(F.broadcast(chosen), "candidate_id", "left")
    able = F.col("route").isNotNull() & (F.col("score") >= quota.minimum_score)
    why = F.when(able & fixed, PINNED).otherwise(F.col("_why"))
    status = F.when(F.col("route").isNull(), "unrouted").when(F.col("score") < quota.minimum_score, "below_threshold").when(why.isNotNull(), "selected").otherwise("overflow")
    return out.withColumn("status", status).withColumn("reason", why).drop("_why").withColumn("priority", F.when(F.col("status") == "selected", priority(F.col("reason"), F.col("track"), F.col("score"), quota.first_priority)))


def review_queue(selected: DataFrame, *, most: int, type_minimums: dict[str, int]) -> DataFrame:
    """At most ``most`` first-priority candidates by score and title; room left goes to types that lack their minimum.

    ``selected`` has candidate_id, title, type, score, priority, model_priority and
    relevance.  Only candidates that the model put into p1 or p2 fill a minimum.
    """
    top = selected.filter("priority = 'priority.p1'").orderBy(F.col("score").desc(), "title", "candidate_id").limit(most)
    have = Counter(r.type for r in top.select("type").collect())
    room = most - sum(have.values())
    lacking = [(t, n - have[t], i) for i, (t, n) in enumerate(type_minimums.items()) if n > have[t]]
    queue = top.withColumn("queued_for", F.lit("priority"))
    if not lacking or room <= 0:
        return queue
    need = selected.sparkSession.createDataFrame(lacking, "type string, need int, turn int")
    order = Window.partitionBy("type").orderBy((F.col("model_priority") == "p1").desc(), F.coalesce("relevance", F.lit(0)).desc(), F.col("score").desc(), "title", "candidate_id")
    rest = selected.filter(F.col("model_priority").isin("p1", "p2")).join(top.select("candidate_id"), "candidate_id", "left_anti").join(F.broadcast(need), "type")
    fill = rest.withColumn("_r", F.row_number().over(order)).filter("_r <= need").orderBy("turn", "_r").limit(room).select(*selected.columns)
    return queue.unionByName(fill.withColumn("queued_for", F.lit("type_minimum")))


@dataclass(frozen=True)
class Wording:
    """What a candidate's reader is told: reasons by route, and what to verify."""

    routes: dict[str, str] = field(default_factory=dict)
    other: str = "Near the subject and worth a check"
    fixed_set: tuple[str, ...] = ("What changed in the watched source, and when?",)
    by_source: tuple[tuple[tuple[str, ...], tuple[str, ...]], ...] = ()
    common: tuple[str, ...] = ("What is new?", "Where does the source state it?")
    by_route: dict[str, str] = field(default_factory=dict)


def explained(candidates: DataFrame, wording: Wording, source_types: str = "source_types") -> DataFrame:
    """``candidates`` with why_candidate (selected ones) and verification_questions."""
    why = rationale(F.col("reason"), F.col("track"), F.col("route"), F.col("matched_signals"), wording.routes, wording.other)
    asked = questions(F.col("track") == "track.fixed", F.col(source_types), F.col("route"), fixed_set=list(wording.fixed_set), by_source=[(k, list(q)) for k, q in wording.by_source], common=list(wording.common), by_route=wording.by_route)
    return candidates.withColumn("why_candidate", F.when(F.col("status") == "selected", why)).withColumn("verification_questions", asked)


def rationale(reason: Column, track: Column, route: Column, signals: Column, texts: dict[str, str], other: str) -> Column:
    """Why a candidate is here: by pin, by watched source, or by route with its first four signals."""
    said = F.lit(other)
    for r, t in texts.items():
        said = F.when(route == r, t).otherwise(said)
    shown = F.slice(signals, 1, 4)
    said = F.concat(said, F.when(F.size(shown) > 0, F.concat(F.lit("; signals: "), F.array_join(shown, ", "))).otherwise(""), F.lit("."))
    return F.when(reason == PINNED, "A sample that was verified before; it tests recall.").when(track == "track.fixed", "A watched source changed several times; confirm what was released.").otherwise(said)


def questions(fixed: Column, source_types: Column, route: Column, *, fixed_set: list[str], by_source: list[tuple[tuple[str, ...], list[str]]], common: list[str], by_route: dict[str, str]) -> Column:
    """What to verify: by watched source, else by the first listed kind of source, else common questions and one of the route."""
    listed = lambda qs: F.array(*[F.lit(q) for q in qs])
    extra = F.array().cast("array<string>")
    for r, q in by_route.items():
        extra = F.when(route == r, F.array(F.lit(q))).otherwise(extra)
    chosen = F.when(fixed, listed(fixed_set))
    for kinds, qs in by_source:
        chosen = chosen.when(F.arrays_overlap(source_types, listed(list(kinds))), listed(qs))
    return chosen.otherwise(F.concat(listed(common), extra))
