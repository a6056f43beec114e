"""The joins of a run, by key; sides are broadcast by Spark's own size checks only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_keywords(specs: DataFrame, groups: DataFrame) -> DataFrame:
    """Each source with the terms of its keyword group, or none."""
    terms = groups.groupBy("keyword_group").agg(F.array_sort(F.collect_set("term")).alias("keywords"))
    return specs.join(terms, "keyword_group", "left").withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>")))


def watched(rows: DataFrame, watchlist: DataFrame, key: str) -> DataFrame:
    return rows.join(watchlist.select(key).distinct(), key, "left_semi")


def missing(watchlist: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return watchlist.join(rows.select(key).distinct(), key, "left_anti")


def members(candidates: DataFrame, records: DataFrame, *, id_col: str = "candidate_id", list_col: str = "source_ids", key: str = "source_id") -> DataFrame:
    """One row per candidate and existing source, with its place in the list."""
    return candidates.select(id_col, F.posexplode(list_col).alias("place", key)).join(records, key)


def collect_members(rows: DataFrame, id_col: str, *fields: str) -> DataFrame:
    """Back to one row per candidate, sources in list order."""
    return rows.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("place", *fields))).alias("sources"))


def coverage(expected: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """Keys that are on one side only, or more than once in ``got``: empty when it covers exactly."""
    left = expected.select(key).distinct().withColumn("wanted", F.lit(True))
    right = got.groupBy(key).agg(F.count("*").alias("n"))
    joined = left.join(right, key, "full_outer")
    problem = F.when(F.col("n").isNull(), "missing").when(F.col("wanted").isNull(), "unexpected").when(F.col("n") > 1, "duplicate")
    return joined.select(key, problem.alias("problem")).filter("problem is not null")


def same_set(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of the child whose key the parent does not have; null keys are not orphans."""
    return child.filter(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def carry_over(current: DataFrame, previous: DataFrame, key: str, *columns: str) -> DataFrame:
    """Columns of the current review, filled from the previous one where they are null."""
    old = previous.select(key, *[F.col(c).alias(f"_old_{c}") for c in columns])
    joined = current.join(old, key, "left")
    return joined.select(*[F.coalesce(c, f"_old_{c}").alias(c) if c in columns else c for c in current.columns])
