"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, the first bytes of its
longer words, its word pairs and its pairs that skip one word.  The model is fitted
on a bounded sample of labelled rows (``max_fit_docs`` documents, one text of each, none of
over ``MAX_FIT_BYTES``), dealt by documents and bytes to a few tasks that each run FTRL-proximal; per-coordinate rates and the L1 term leave
few weights, whose mean over the tasks is broadcast (at most 2**BITS numbers).

Defined results: null, empty and word-less texts have no features and score the
bias alone; rows with a null label or id are not learnt from; a document labelled
several times counts as toxic if any of its labels says so; without any label the
score is 0.  Columns other than the id and the text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import textbytes as tb
from siltworks.llm.workspace import Tables

BITS = 20
#: Labelled documents used for the fit: those whose id hashes lowest.
MAX_FIT_DOCS = 20_000
DOCS_PER_TASK, BYTES_PER_TASK = 5_000, 64 << 20
#: Longer texts are scored whole but not learnt from.
MAX_FIT_BYTES = 4 << 20
FOLDS = 5
PREFIX = 4
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    index: np.ndarray
    weight: np.ndarray
    bias: float


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, rows) by kind of feature; a row may repeat an index."""
    starts, ends, bounds = tb.words(data, offsets)
    h = tb.hashes(data, starts, ends)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    shift = np.uint64(64 - BITS)
    yield (h >> shift).astype(np.int64), rows
    long = (ends - starts) > PREFIX
    yield (tb.mix64(tb.hashes(data, starts[long], starts[long] + PREFIX) ^ MULTIPLIER) >> shift).astype(np.int64), rows[long]
    for gap in (1, 2):
        if len(h) > gap:
            same = rows[gap:] == rows[:-gap]
            pair = (h[:-gap] * MULTIPLIER + h[gap:] * np.uint64(2 * gap + 1))[same]
            yield (tb.mix64(pair) >> shift).astype(np.int64), rows[:-gap][same]


def ftrl(docs: list[np.ndarray], labels: np.ndarray, *, alpha: float = 1.0, beta: float = 1.0, l1: float = 15.0, l2: float = 1.0, epochs: int = 8, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias after several passes over the documents in a fixed random order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = nb = 0.0
    order = np.random.Generator(np.random.PCG64(seed))
    bias = 0.0
    for _ in range(epochs):
        for i in order.permutation(len(docs)):
            x = docs[i]
            zi, ni = z[x], n[x]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + root) / alpha + l2))
            bias = -zb / ((beta + nb**0.5) / alpha)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - labels[i]
            z[x] = zi + g - (np.sqrt(ni + g * g) - root) / alpha * w
            n[x] = ni + g * g
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / alpha * bias
            nb += g * g
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)), bias


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_fit_docs: int = MAX_FIT_DOCS) -> Model:
    """Fit on the rows whose crc32(id) mod 5 is not 0."""
    key = F.col(id_col)
    picked = (
        labels.filter(F.col(label_col).isNotNull() & key.isNotNull() & (tb.labelled_part(key, FOLDS) != 0))
        .groupBy(key.alias("_k"))
        .agg(F.max(F.col(label_col).cast("int")).alias("_y"))
        .orderBy(F.xxhash64("_k"), "_k")
        .limit(max_fit_docs)
    )
    # The picked rows are at most max_fit_docs of two numbers.
    found = docs.select(key.alias("_k"), F.col(text_col).alias("_t")).join(F.broadcast(picked), "_k").filter(F.coalesce(F.octet_length("_t"), F.lit(0)) <= MAX_FIT_BYTES)
    # One text of an id, however often it is repeated: the one that hashes lowest.
    tables = Tables(docs.sparkSession, "toxicity")
    sample = tables.keep(found.groupBy("_k", "_y").agg(F.min(F.struct(F.xxhash64("_t"), "_t")).alias("_m")).select("_k", "_m._t", "_y"), "sample")
    n, size = sample.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_t")), F.lit(0))).first()
    tasks = max(1, n // DOCS_PER_TASK, size // BYTES_PER_TASK)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tb.slices(batch.column(1)):
                parts = list(features(data, offsets))
                keys = np.unique(np.concatenate([r * (1 << BITS) + x for x, r in parts]))
                cut = np.searchsorted(keys, np.arange(b - a + 1) << BITS)
                x = (keys & ((1 << BITS) - 1)).astype(np.int32)
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array([x[cut[i] : cut[i + 1]].tobytes() for i in range(b - a)], pa.binary()), batch.column(2).slice(a, b - a)], names=["k", "x", "y"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((k, y, x) for batch in batches for k, x, y in zip(*(c.to_pylist() for c in (batch.column("k"), batch.column("x"), batch.column("y")))))
        w, bias = ftrl([np.frombuffer(x, np.int32) for _, _, x in rows], np.array([y for _, y, _ in rows], float))
        at = np.flatnonzero(w)
        yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(w[at], bias))], names=["i", "w"])

    dealt = sample.select("_k", "_t", "_y").mapInArrow(extract, f"k {sample.schema['_k'].dataType.simpleString()}, x binary, y int").withColumn("task", F.pmod(F.xxhash64("k"), F.lit(tasks)))
    rows = dealt.groupBy("task").applyInArrow(train, "i bigint, w double").groupBy("i").agg((F.sum("w") / tasks).alias("w")).collect() if n else []
    tables.drop_others()
    found = sorted((r.i, r.w) for r in rows)
    bias = found[0][1] if found and found[0][0] == -1 else -35.0
    found = [x for x in found if x[0] >= 0]
    return Model(np.array([i for i, _ in found], np.int64), np.array([w for _, w in found]), bias)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    frame, text_of = tb.text_input(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        weight = np.zeros(1 << BITS)
        weight[model.index] = model.weight
        used = weight != 0
        for batch in batches:
            for a, b, data, offsets in tb.slices(text_of(batch)):
                hits = [np.zeros(0, np.int64)]
                for x, r in features(data, offsets):
                    at = np.flatnonzero(used[x])
                    hits.append(r[at] * (1 << BITS) + x[at])
                keys = np.unique(np.concatenate(hits))
                total = np.bincount(keys >> BITS, weight[keys & ((1 << BITS) - 1)], b - a) + model.bias
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))], names=["_id", "score"])

    return frame.mapInArrow(run, f"_id {frame.schema['_id'].dataType.simpleString()}, score double").withColumnRenamed("_id", id_col)


def drop_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Documents below the threshold, in the columns of ``docs``."""
    return score(tb.as_rows(docs), model, id_col="row", text_col=f"row.{text_col}").filter(F.col("score") < threshold).select("row.*")


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", (tb.labelled_part(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
