"""Rule scores, types and tags: narrow expressions over literal rule tables, no shuffle."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.text import matches, normalize_title


@dataclass(frozen=True)
class Rules:
    """All rule tables of a run; nothing is kept in module state."""

    routes: dict[str, dict[str, int]]
    precedence: tuple[str, ...] = ()
    markers: dict[str, tuple[str, ...]] = field(default_factory=dict)
    hard_terms: tuple[str, ...] = ()
    soft_terms: dict[str, int] = field(default_factory=dict)
    boosts: dict[str, int] = field(default_factory=dict)
    types: dict[str, tuple[str, ...]] = field(default_factory=dict)
    type_precedence: tuple[str, ...] = ()
    source_boosts: dict[str, dict[str, int]] = field(default_factory=dict)
    type_boosts: dict[str, int] = field(default_factory=dict)
    #: The source types of the record contract that count as primary.
    primary_source_types: tuple[str, ...] = ("paper_report", "official_announcement", "code_dataset", "financial_report", "company_news", "public_report")
    context_source_type: str = "financial_report"
    watch_prefix: str | None = None
    watch_route: str | None = None
    maintenance_titles: tuple[str, ...] = ()
    tags: dict[str, dict[str, tuple[str, ...]]] = field(default_factory=dict)
    route_tags: dict[str, str] = field(default_factory=dict)
    default_scene: str = "scene.general"
    minimum_score: int = 7

    def order(self) -> tuple[str, ...]:
        return (*self.precedence, *sorted(set(self.routes) - set(self.precedence)))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _terms(terms: dict[str, int]) -> Column:
    """A literal table of terms and weights; an empty one keeps its type."""
    rows = [F.struct(F.lit(t).alias("t"), F.lit(w).alias("w")) for t, w in terms.items()]
    return F.array(*rows) if rows else F.array().cast("array<struct<t:string,w:int>>")


def _found(low: Column, table: Column) -> Column:
    """Weights of the terms of a table that a lower-cased text contains."""
    return F.transform(F.filter(table, lambda x: F.contains(low, x["t"])), lambda x: x["w"])


def _named(low: Column, terms) -> Column:
    """The terms that a lower-cased text contains, sorted."""
    return F.filter(_strings(sorted(set(terms))), lambda t: F.contains(low, F.lower(t)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, w: a + w)


def _best(values: Column) -> Column:
    return F.coalesce(F.array_max(values), F.lit(0))


def route_scores(text: Column, rules: Rules) -> Column:
    """map(route, sum of the weights of its terms), routes without a term left out."""
    low = F.lower(F.coalesce(text, F.lit("")))
    every = F.map_from_arrays(_strings(rules.routes), F.array(*[_sum(_found(low, _terms(t))) for t in rules.routes.values()]))
    return F.map_filter(every, lambda _, v: v > 0)


def classify_type(low: Column, source_types: Column, rules: Rules) -> Column:
    """struct(kind, score) of a lower-cased text: twice the distinct terms plus each member's source boost.

    Ties go by precedence; every member of a cluster adds its boost.
    """
    kinds = (*rules.type_precedence, *sorted(set(rules.types) - set(rules.type_precedence)))
    rows = []
    for rank, kind in enumerate(kinds):
        boosts = {s: b[kind] for s, b in rules.source_boosts.items() if kind in b}
        table = F.map_from_arrays(_strings(boosts), F.array(*[F.lit(v) for v in boosts.values()]) if boosts else F.array().cast("array<int>"))
        rows.append(F.struct(F.lit(kind).alias("kind"), F.lit(-rank).alias("rank"), _strings([t.lower() for t in rules.types.get(kind, ())]).alias("terms"), table.alias("boosts")))
    own = lambda k: F.aggregate(source_types, F.lit(0), lambda a, s: a + F.coalesce(F.try_element_at(k["boosts"], s), F.lit(0)))
    options = F.transform(F.array(*rows), lambda k: F.struct((F.size(F.filter(k["terms"], lambda t: F.contains(low, t))) * 2 + own(k)).alias("score"), k["rank"].alias("rank"), k["kind"].alias("kind")))
    return F.transform(F.array(F.array_max(options)), lambda x: F.struct(x["kind"].alias("kind"), x["score"].alias("score")))[0]


def type_signals(low: Column, source_types: Column, kind: Column, rules: Rules) -> Column:
    """What spoke for ``kind``: ``content:`` its terms in the text, sorted, then ``source_type:`` of each member that raises it."""
    out = F.array().cast("array<string>")
    for k in rules.types:
        raising = [s for s, boosts in rules.source_boosts.items() if k in boosts]
        said = F.transform(_named(low, rules.types[k]), lambda t: F.concat(F.lit("content:"), t))
        members = F.transform(F.filter(source_types, lambda s: F.array_contains(_strings(raising), s)), lambda s: F.concat(F.lit("source_type:"), s))  # noqa: B023 - read at once
        out = F.when(kind == k, F.concat(said, members)).otherwise(out)
    return out


def atomic_tags(low: Column, primary_route: Column, rules: Rules) -> Column:
    """struct of sorted distinct tags by group, of a lower-cased text; scene falls back to the default."""
    groups = {}
    for group, table in rules.tags.items():
        rows = F.array(*[F.struct(F.lit(tag).alias("tag"), _strings([t.lower() for t in terms]).alias("terms")) for tag, terms in table.items()])
        groups[group] = F.transform(F.filter(rows, lambda r: F.exists(r["terms"], lambda t: F.contains(low, t))), lambda r: r["tag"])
    if rules.route_tags:
        lead = F.map_from_arrays(_strings(rules.route_tags), _strings(rules.route_tags.values()))
        groups["tech"] = F.filter(F.concat(groups.get("tech", F.array().cast("array<string>")), F.array(F.try_element_at(lead, primary_route))), lambda t: t.isNotNull())
    if "scene" in groups:
        groups["scene"] = F.when(F.size(groups["scene"]) > 0, groups["scene"]).otherwise(F.array(F.lit(rules.default_scene)))
    return F.struct(*[F.array_sort(F.array_distinct(v)).alias(k) for k, v in groups.items()])


def score_records(df: DataFrame, rules: Rules, *, title: str = "title", excerpt: str = "excerpt", source_type: str = "source_type", source_name: Column | None = None, context: Column | None = None) -> DataFrame:
    """``df`` with score, primary_route, secondary_routes, routes, hard, soft, negative, kind and kind_score.

    ``soft`` is the sum of the soft terms' weights, ``negative`` names them.

    A route's score is its best term in the title, up to 3 for more terms there, up to
    2 for its best term in the excerpt and up to 1 in the context of a filing.  Routes
    marked in the title lead, then those in the title by weight, then the rest by score.
    The context routes a record but never counts as evidence.  One narrow pass: the rules
    are a literal table that each text is held against once.
    """
    rows = [
        F.struct(F.lit(r).alias("route"), F.lit(i).alias("o"), F.lit(r == rules.watch_route).alias("watch"), _strings(rules.markers.get(r, ())).alias("marks"), _terms(rules.routes[r]).alias("terms"))
        for i, r in enumerate(rules.order())
    ]
    empty = F.lit("")
    watched = F.coalesce(source_name.startswith(rules.watch_prefix), F.lit(False)) if rules.watch_prefix and source_name is not None else F.lit(False)
    shown = F.when(F.col(source_type) == rules.context_source_type, F.coalesce(context, empty)).otherwise(empty) if context is not None else empty
    out = df.withColumns({"_lt": F.lower(F.coalesce(title, empty)), "_le": F.lower(F.coalesce(excerpt, empty)), "_lc": F.lower(shown), "_watched": watched})
    out = out.withColumn("_ev", F.concat_ws(" ", "_lt", "_le"))
    hits = F.transform(
        F.array(*rows),
        lambda r: F.struct(
            r["route"].alias("route"),
            r["o"].alias("o"),
            (r["watch"] & F.col("_watched")).alias("watch"),
            F.exists(r["marks"], lambda m: F.contains(F.col("_lt"), m)).alias("marked"),
            _found(F.col("_lt"), r["terms"]).alias("t"),
            _found(F.col("_le"), r["terms"]).alias("e"),
            _found(F.col("_lc"), r["terms"]).alias("c"),
        ),
    )
    hits = F.filter(hits, lambda h: h["watch"] | h["marked"] | (F.size(h["t"]) + F.size(h["e"]) + F.size(h["c"]) > 0))

    def points(h: Column) -> Column:
        total = _best(h["t"]) + F.least(F.lit(3), F.greatest(F.lit(0), F.size(h["t"]) - 1)) + F.least(F.lit(2), F.floor(_best(h["e"]) / 4)) + F.least(F.lit(1), F.floor(_best(h["c"]) / 4))
        return F.when(h["watch"], F.greatest(total, F.lit(8))).otherwise(total).cast("int")

    def place(h: Column) -> Column:
        """Marked first, then by title weight, then by score; precedence settles each."""
        group = F.when(h["marked"], 0).when(F.size(h["t"]) > 0, 1).otherwise(2)
        value = F.when(h["marked"], 0).when(F.size(h["t"]) > 0, -_best(h["t"])).otherwise(-points(h))
        return F.struct(group.alias("group"), value.alias("value"), h["o"].alias("o"), h["route"].alias("route"), points(h).alias("points"))

    out = out.withColumn("_ranked", F.array_sort(F.transform(hits, place)))
    out = out.withColumn("_kind", classify_type(F.col("_ev"), F.array(source_type), rules))
    soft = _sum(_found(F.col("_ev"), _terms(rules.soft_terms)))
    boost = F.greatest(_best(_found(F.col("_ev"), _terms(rules.boosts))), F.when(F.col("_watched"), 4).otherwise(0))
    kind_boost = F.lit(0)
    for k, v in rules.type_boosts.items():
        kind_boost = F.when(F.col("_kind.kind") == k, v).otherwise(kind_boost)
    trusted = F.when(F.col(source_type).isin(*rules.primary_source_types), 2).otherwise(0)
    chore = F.when(normalize_title(F.col(title)).isin(*rules.maintenance_titles), -8).otherwise(0) if rules.maintenance_titles else F.lit(0)
    lead = F.get("_ranked", F.lit(0))
    return out.withColumns(
        {
            "score": (F.coalesce(lead["points"], F.lit(0)) + F.least(F.lit(3), F.greatest(F.lit(0), F.size("_ranked") - 1)) + boost + soft + kind_boost + trusted + chore).cast("int"),
            "primary_route": lead["route"],
            "secondary_routes": F.transform(F.slice("_ranked", 2, 3), lambda x: x["route"]),
            "routes": F.transform("_ranked", lambda x: F.struct(x["route"].alias("route"), x["points"].alias("points"))),
            "hard": matches(F.col(title), list(rules.hard_terms)),
            "soft": soft,
            "negative": _named(F.col("_ev"), rules.soft_terms),
            "kind": F.col("_kind.kind"),
            "kind_score": F.col("_kind.score"),
        }
    ).drop("_lt", "_le", "_lc", "_ev", "_watched", "_ranked", "_kind")
