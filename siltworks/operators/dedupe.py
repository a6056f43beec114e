"""One row per key, by explicit rank; every tie is settled by columns of the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How much of a source was readable; anything else ranks below all of these.
ACCESS_RANK = {"success": 3, "partial": 2, "blocked": 1, "failed": 0}


def access_rank(status: Column) -> Column:
    rank = F.lit(-1)
    for name, value in ACCESS_RANK.items():
        rank = F.when(status == name, value).otherwise(rank)
    return rank


def best_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rank = 1").drop("_rank")


def best_access(records: DataFrame, ord_col: str = "ord") -> DataFrame:
    """One record per canonical URL: the best access, then the earliest.

    A hot URL is pre-aggregated in each task (max_by keeps one row), not sorted whole.
    """
    names = records.columns
    best = F.max_by(F.struct(*names), F.struct(access_rank(F.col("access_status")).alias("a"), (-F.col(ord_col)).alias("o")))
    return records.groupBy("canonical_url").agg(best.alias("row")).select("row.*")


def collection_order(records: DataFrame) -> DataFrame:
    """Newest first, undated last; then by name, from the end of the alphabet."""
    return records.orderBy(F.col("published_at").desc_nulls_last(), F.col("source_name").desc_nulls_last())


def overlay_fallback(current: DataFrame, fallback: DataFrame, start: Column, end: Column, *, failed: DataFrame | None = None, run_id: str | None = None) -> DataFrame:
    """A run whose failed sources take the in-window successes of an earlier run.

    ``failed`` has the registry_id of sources whose check failed, with or without records;
    by default they are read from the records.  The current run wins each URL; of restored
    sources its rows that were not successes go.  The result has a column ``restored``;
    with ``run_id``, restored rows name the run they come from in ``discovery_context``.
    """
    from siltworks.operators.predicates import in_window

    if failed is None:
        failed = current.groupBy("registry_id").agg(F.max(access_rank(F.col("access_status"))).alias("a")).filter("a <= 0")
    usable = fallback.filter((F.col("access_status") == "success") & in_window(F.col("published_at"), start, end)).join(failed.select("registry_id").distinct(), "registry_id", "left_semi")
    if run_id is not None:
        usable = usable.withColumn("discovery_context", F.concat_ws("; ", F.nullif(F.col("discovery_context"), F.lit("")), F.lit(f"fallback_collection:{run_id}")))
    restored = usable.select("registry_id").distinct().withColumn("_restored", F.lit(True))
    gone = F.col("_restored").isNotNull() & ~F.coalesce(F.col("access_status") == "success", F.lit(False))
    kept = current.join(restored, "registry_id", "left").filter(~gone).select(*current.columns).withColumn("restored", F.lit(False))
    both = kept.unionByName(usable.withColumn("restored", F.lit(True)))
    return best_per_key(both, ["canonical_url"], F.col("restored").asc(), access_rank(F.col("access_status")).desc(), F.col("ord").asc())


def fallback_counts(overlaid: DataFrame) -> DataFrame:
    """(registry_id, restored_records) of the sources that an earlier run stood in for."""
    return overlaid.filter("restored").groupBy("registry_id").agg(F.count("*").alias("restored_records"))


def union_override(base: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """Rows of both; where a key is in both, those of ``extra``."""
    return base.join(extra.select(key).distinct(), key, "left_anti").unionByName(extra)


def ordered_distinct(first: Column, second: Column) -> Column:
    return F.array_union(first, second)
