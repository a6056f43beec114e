"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: the k-th source by code point (null last) weighs 3, 1, 2, repeating; the
sources share ``share`` times all words by weight, a target stops at ``epochs``
times its source's size, and the excess is shared again by weight.

Schedule: slot i of the mix takes the point frac((i + 1/2) x golden ratio), mapped
through the cumulative targets, counted in blocks, to a source; slots are ranked inside
their source.  Each source's documents, shuffled by hash, lie on a line of words that is
cut into blocks of equal words; the slot of rank r takes block r modulo the number of
blocks, as long as r is within the allowed epochs.  A document is taken as often as the
taken blocks cover its words.

All steps are joins and aggregates on keys that spread: the running word positions
of a source are sums over hash buckets plus sums inside a bucket, and ranks of slots
are counts over runs of slots plus ranks inside a run.  The block length grows with all
words, so that large sources share about ``SLOTS`` slots at every size, but never beyond
what leaves a source ``SOURCE_BLOCKS`` blocks: a small source beside huge ones keeps its
target.

Defined results: a null text has size 0 and is never taken; a source without words
has target 0; repeated rows are separate documents of the line; a null source is a
source of its own; without any word every target is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.workspace import with_checkpoints

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SLOTS = 1 << 19
MIN_BLOCK = 8
#: Blocks of a source at least, down to blocks of MIN_BLOCK words; of still smaller ones, LEAST_BLOCKS down to single words.
SOURCE_BLOCKS, LEAST_BLOCKS = 1024, 256
RUN = 1 << 15
GOLDEN = 0.6180339887498949
#: Refused beyond this; the plan of so many sources is what is broadcast.
MAX_SOURCES = 100_000
#: Hash buckets of a source's line.
BUCKETS = 4096


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size): words are runs of ``[^\\x20\\x09-\\x0D]``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("size"))


def targets(sizes: DataFrame, *, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(source, nth, source_size, target) with nth counted from 0 by code point, null last."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on: aggregated, and small beside the documents.
    per = per.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.lit(float(epochs)) * F.col("source_size"))
    fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "nth")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    per = per.withColumn("total", F.lit(share) * F.sum("source_size").over(Window.partitionBy()))
    per = per.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # The first source, by cap per weight, that stays under its cap fixes the common level.
    under = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    per = per.withColumn("common", F.first(under, ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return per.select("source", "nth", "source_size", F.coalesce(F.least(F.col("cap"), F.when(F.col("common").isNotNull(), F.col("common") * F.col("weight"))), F.col("cap")).alias("target"))


def block_lengths(plan: DataFrame, words: int) -> DataFrame:
    """``plan`` with each source's block length, given the words of all sources."""
    own = F.greatest(F.expr(f"source_size div {SOURCE_BLOCKS}"), F.least(F.lit(MIN_BLOCK), F.greatest(F.lit(1), F.expr(f"source_size div {LEAST_BLOCKS}"))))
    return plan.withColumn("length", F.least(F.lit(max(MIN_BLOCK, words // SLOTS)), own).cast("bigint"))


def schedule(spark, plan: list) -> DataFrame:
    """(id, nth, rank) for each slot of the mix; ``plan`` has rows with nth, target and block length."""
    wanted = [r for r in plan if r.target > 0]
    edges = np.cumsum([r.target / r.length for r in wanted])
    nth = np.array([r.nth for r in wanted], np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = (batch.column(0).to_numpy() + 0.5) * GOLDEN
            at = np.searchsorted(edges, (x - np.floor(x)) * edges[-1], side="right")
            yield pa.record_batch([batch.column(0), pa.array(nth[np.minimum(at, len(nth) - 1)])], names=["id", "nth"])

    slots = spark.range(int(round(edges[-1])) if wanted else 0).mapInArrow(place, "id bigint, nth bigint").withColumn("run", F.floor(F.col("id") / RUN))
    per = slots.groupBy("nth", "run").agg(F.count("*").alias("n"))
    base = per.select("nth", "run", (F.sum("n").over(Window.partitionBy("nth").orderBy("run")) - F.col("n")).alias("base"))
    local = slots.withColumn("r", F.row_number().over(Window.partitionBy("nth", "run").orderBy("id")) - 1)
    return local.join(base, ["nth", "run"]).select("id", "nth", (F.col("base") + F.col("r")).alias("rank"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    spark = with_checkpoints(docs.sparkSession)
    sizes = sized(docs, id_col, text_col, source_col).checkpoint()
    if sizes.select("source").distinct().limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    plan = targets(sizes, weights=weights, share=share, epochs=epochs).checkpoint()
    plan = block_lengths(plan, plan.agg(F.sum("source_size")).first()[0] or 0)
    rows = plan.select("nth", "target", "length").orderBy("nth").collect()
    # The plan has at most MAX_SOURCES rows of five short values.
    line = sizes.join(F.broadcast(plan.withColumnRenamed("source", "s")), F.expr("source <=> s")).select("doc_id", "size", "nth", "source_size", "target", "length")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    line = line.withColumn("o", F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")).withColumn("bucket", F.expr(f"o div {(1 << 60) // BUCKETS}"))
    per = line.groupBy("nth", "bucket").agg(F.sum("size").alias("n"))
    base = per.select("nth", "bucket", (F.sum("n").over(Window.partitionBy("nth").orderBy("bucket")) - F.col("n")).alias("base"))
    inside = Window.partitionBy("nth", "bucket").orderBy("o", "doc_id", "size")
    line = line.withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("place", F.row_number().over(inside))
    line = line.join(base, ["nth", "bucket"]).withColumn("start", F.col("base") + F.col("upto") - F.col("size")).drop("base", "upto", "o")
    blocks = F.expr("(source_size + length - 1) div length")
    slots = schedule(spark, rows).join(F.broadcast(plan.select("nth", "source_size", "length")), "nth").filter(F.col("rank") < epochs * blocks)
    times = slots.groupBy("nth", (F.col("rank") % blocks).alias("block")).agg(F.count("*").alias("times"))
    cut = F.when(F.col("size") > 0, F.sequence(F.expr("start div length"), F.expr("(start + size - 1) div length")))
    spread = line.withColumn("block", F.explode_outer(cut)).join(times, ["nth", "block"], "left")
    cover = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("length")) - F.greatest(F.col("start"), F.col("block") * F.col("length"))
    whole = ["doc_id", "nth", "bucket", "place", "size", "source_size", "target"]
    return spread.groupBy(*whole).agg(F.coalesce(F.sum(cover * F.coalesce("times", F.lit(0))), F.lit(0)).cast("bigint").alias("taken")).select("doc_id", "size", "source_size", "target", "taken")


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def mixing_sql() -> str:
    """The same mix in SQL, with each source's own block length."""
    return f"""
WITH sizes AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS nth FROM sizes GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][(nth % 3) + 1] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS cap FROM per),
lv AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
common AS (SELECT arg_min(level, cap / weight) AS level FROM lv WHERE level * weight <= cap),
plan AS (
  SELECT source, nth, source_size, CASE WHEN common.level IS NULL THEN cap ELSE least(cap, common.level * weight) END AS target,
    least(greatest({MIN_BLOCK}, sum(source_size) OVER () // {SLOTS}), greatest(source_size // {SOURCE_BLOCKS}, least({MIN_BLOCK}, greatest(1, source_size // {LEAST_BLOCKS}))))::BIGINT AS length
  FROM lv, common),
edges AS (SELECT nth, target / length AS wide, sum(target / length) OVER (ORDER BY nth) AS high FROM plan WHERE target > 0),
slot AS (SELECT i, ((i + 0.5::DOUBLE) * {GOLDEN}::DOUBLE - floor((i + 0.5::DOUBLE) * {GOLDEN}::DOUBLE)) * (SELECT max(high) FROM edges) AS p
  FROM (SELECT unnest(range(CAST(round_even(max(high), 0) AS BIGINT))) AS i FROM edges)),
placed AS (SELECT slot.i, edges.nth FROM slot JOIN edges ON slot.p < edges.high AND slot.p >= edges.high - edges.wide),
ranked AS (SELECT nth, row_number() OVER (PARTITION BY nth ORDER BY i) - 1 AS r FROM placed),
times AS (
  SELECT r.nth, r.r % ((p.source_size + p.length - 1) // p.length) AS block, count(*) AS times
  FROM ranked r JOIN plan p ON r.nth = p.nth WHERE r.r < 2 * ((p.source_size + p.length - 1) // p.length) GROUP BY 1, 2),
line AS (
  SELECT s.doc_id, s.size, p.nth, p.source_size, p.target, p.length,
    sum(s.size) OVER (PARTITION BY p.nth ORDER BY md5(coalesce(CAST(s.doc_id AS VARCHAR), '')), s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size AS start
  FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
spread AS (SELECT *, unnest(range(CAST(start // length AS BIGINT), CAST((start + size - 1) // length + 1 AS BIGINT))) AS block FROM line WHERE size > 0),
got AS (
  SELECT s.doc_id, s.nth, s.start, CAST(sum((least(s.start + s.size, (s.block + 1) * s.length) - greatest(s.start, s.block * s.length)) * coalesce(t.times, 0)) AS BIGINT) AS taken
  FROM spread s LEFT JOIN times t ON s.nth = t.nth AND s.block = t.block GROUP BY 1, 2, 3)
SELECT line.doc_id, line.size, line.source_size, line.target, CAST(coalesce(got.taken, 0) AS BIGINT) AS taken
FROM line LEFT JOIN got ON line.doc_id = got.doc_id AND line.nth = got.nth AND line.start = got.start AND line.size > 0
"""


OP9_SQL = mixing_sql()
