"""Counts and roll-ups of a run: ordinary aggregates with partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def run_summary(records: DataFrame) -> DataFrame:
    """One row: records by access status, dated records and distinct sources."""
    status = lambda s: F.count_if(F.col("access_status") == s).alias(s)
    return records.agg(F.count("*").alias("records"), status("success"), status("partial"), status("blocked"), status("failed"), F.count("published_at").alias("dated"), F.count_distinct("source_name").alias("sources"))


def source_health(records: DataFrame, scanned: Column, eligible: Column, accepted: Column, key: str = "registry_id") -> DataFrame:
    return records.groupBy(key).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in (("scanned", scanned), ("eligible", eligible), ("accepted", accepted))])


def histogram(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def processing_summary(candidates: DataFrame) -> DataFrame:
    """Candidates, members and collapsed members by method of aggregation."""
    return candidates.groupBy("method").agg(F.count("*").alias("candidates"), F.sum("source_count").cast("bigint").alias("members"), F.sum(F.col("source_count") - 1).cast("bigint").alias("collapsed"))


def usage_totals(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in columns])


def recall(expected: DataFrame, present: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    """Each expected key with whether it is present and selected."""
    flag = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(True))
    return (
        expected.select(key).distinct().join(flag(present, "present"), key, "left").join(flag(selected, "selected"), key, "left").select(key, F.coalesce("present", F.lit(False)).alias("present"), F.coalesce("selected", F.lit(False)).alias("selected"))
    )


def top_per_group(df: DataFrame, group: str, n: int, *order: Column, rank: str = "rank") -> DataFrame:
    """The first n rows of each group; Spark prunes each task's groups before it shuffles."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col(rank) <= n)


def decisions(reviews: DataFrame) -> DataFrame:
    is_ = lambda d: F.count_if(F.col("decision") == d)
    return reviews.agg(F.count("*").alias("reviewed"), is_("include").alias("include"), is_("watch").alias("watch"), is_("exclude").alias("exclude"))
