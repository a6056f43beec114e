"""Filters that a run applies, as Column predicates; a null never passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.text import matches_any


def in_window(ts: Column, start: Column, end: Column) -> Column:
    """Both ends belong to the window."""
    return F.coalesce(ts.between(start, end), F.lit(False))


def in_calendar_window(ts: Column, start: Column, end: Column) -> Column:
    return F.coalesce(F.to_date(ts).between(F.to_date(start), F.to_date(end)), F.lit(False))


def passes_terms(text: Column, include: list[str] = (), exclude: list[str] = ()) -> Column:
    """Some included term (all pass where none is named) and no excluded one."""
    wanted = matches_any(text, list(include)) if include else F.lit(True)
    return wanted & ~(matches_any(text, list(exclude)) if exclude else F.lit(False))


def url_allowed(url: Column, pattern: str | None) -> Column:
    return F.coalesce(url.rlike(pattern), F.lit(False)) if pattern else F.lit(True)


def enabled_sources(registry: DataFrame, selected: list[str] | None = None) -> DataFrame:
    """Enabled entries, or those of the selected ids; an unknown id is an error."""
    rows = registry.filter(F.coalesce("enabled", F.lit(True)))
    if not selected:
        return rows
    wanted = registry.sparkSession.createDataFrame([(x,) for x in selected], "registry_id string")
    unknown = [r.registry_id for r in wanted.join(registry, "registry_id", "left_anti").collect()]
    if unknown:
        raise ValueError(f"unknown registry ids: {sorted(unknown)}")
    return rows.join(F.broadcast(wanted), "registry_id", "left_semi")


def split_scored(scored: DataFrame, minimum: int) -> DataFrame:
    """``scored`` with a decision: excluded, unrouted, below_threshold or eligible."""
    decision = (
        F.when(F.size("hard") > 0, "excluded").when(F.col("primary_route").isNull(), "unrouted").when(F.col("score") < minimum, "below_threshold").otherwise("eligible")
    )
    return scored.withColumn("decision", decision)


def allowed(value: Column, listed: list[str]) -> Column:
    return F.coalesce(value.isin(*listed), F.lit(False))
