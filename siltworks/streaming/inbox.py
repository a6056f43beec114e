"""Streaming ingest beyond the batch run: pushed urls become Bronze records once.

Files are read as a stream; records later than the watermark may be dropped, so the
delay bounds the state by urls per delay, not by all urls ever seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.urls import canonicalize_url

SCHEMA = "url string, discovered_at timestamp, discovered_by string, discovery_context string, source_name string, publisher string, enabled boolean"


def read(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(path)


def once(rows: DataFrame, delay: str = "7 days") -> DataFrame:
    """Enabled rows with their canonical url, the first of each inside the watermark."""
    kept = rows.filter(F.coalesce("enabled", F.lit(True)) & (F.btrim(F.coalesce("url", F.lit(""))) != "") & F.col("discovered_at").isNotNull())
    return kept.withColumn("canonical_url", canonicalize_url(F.col("url"))).withWatermark("discovered_at", delay).dropDuplicatesWithinWatermark(["canonical_url"])


def counts(rows: DataFrame, size: str = "1 day", delay: str = "7 days") -> DataFrame:
    """Urls per day and finder, final once the watermark passes the day."""
    return rows.withWatermark("discovered_at", delay).groupBy(F.window("discovered_at", size).alias("w"), "discovered_by").agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "discovered_by", "n")


def write(rows: DataFrame, table_path: str, checkpoint: str):
    """Appends all that is there and stops; a restart goes on from the checkpoint."""
    return rows.writeStream.format("parquet").option("path", table_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
