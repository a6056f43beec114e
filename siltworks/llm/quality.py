"""Document quality from a linear-chain conditional random field over lines.

Every line is described by its own features and those of its neighbours; the chain
labels lines good or bad.  Each labelled document lends its label to its lines.
Forward-backward gives each line's marginal, and the document's score is their
mean weighted by line length.

The fit uses a bounded sample of labelled rows (``MAX_FIT_DOCS`` documents of lowest id
hash, one text of each, none of over ``MAX_FIT_BYTES``), dealt by lines to tasks whose
weights are averaged; scoring is one narrow pass over whole texts.

Defined results: null and empty texts are one empty line; rows with a null label or
id are not learnt from; of several labels of a document the lowest counts; without
any label the score is 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import textbytes as tb
from siltworks.llm.workspace import Tables

#: Labelled documents used for the fit: those whose id hashes lowest.
MAX_FIT_DOCS = 6_000
LINES_PER_TASK = 200_000
#: Longer texts are scored whole but not learnt from.
MAX_FIT_BYTES = 256 << 10
FOLDS = 5
THRESHOLD = 0.3

_b = np.arange(256)
UPPER = (_b >= 65) & (_b <= 90)
ALPHA = UPPER | ((_b >= 97) & (_b <= 122)) | (_b >= 128)
DIGIT = (_b >= 48) & (_b <= 57)
SPACE = (_b == 32) | ((_b >= 9) & (_b <= 13))
BAR = (_b == 124) | (_b == 9)
BANG = (_b == 33) | (_b == 63)
STOP = np.isin(_b, [44, 45, 46, 39, 34, 58, 59, 40, 41])
SYMBOL = ~(ALPHA | DIGIT | SPACE | BAR | BANG | STOP)
LATIN_UPPER = 0xC3
N_OWN = 12


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds) of the lines of each row; an empty text has one empty line."""
    breaks = np.flatnonzero(data == 10)
    row = np.searchsorted(offsets, breaks, side="right") - 1
    rows = np.concatenate([row, np.arange(len(offsets) - 1)])
    starts = np.concatenate([breaks + 1, offsets[:-1]])
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    bounds = np.searchsorted(rows, np.arange(len(offsets)))
    ends = np.append(starts[1:] - 1, 0)
    ends[bounds[1:] - 1] = offsets[1:]
    return starts, ends, bounds


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, byte lengths, bounds): a row of features for each line."""
    starts, ends, bounds = lines(data, offsets)
    size = ends - starts

    def share(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        return total[ends] - total[starts]

    upper, alpha = share(UPPER), share(ALPHA)
    after = np.zeros(256, bool)
    after[0x80:0x9F] = True
    # Upper-case Latin letters with marks are C3 80 to C3 9E.
    marked = np.zeros(len(data) + 1, np.int64)
    if len(data) > 1:
        marked[2:] = np.cumsum((data[:-1] == LATIN_UPPER) & after[data[1:]])
    upper = upper + 2 * (marked[ends] - marked[np.minimum(starts + 1, len(data))]).clip(0)
    ws, we, _ = tb.words(data, offsets)
    h = tb.hashes(data, ws, we)
    at = np.searchsorted(starts, ws, side="right") - 1
    n_words = np.bincount(at, minlength=len(starts))
    again = np.zeros(len(h), bool)
    if len(h) > 1:
        again[1:] = (h[1:] == h[:-1]) & (at[1:] == at[:-1])
    repeated = np.bincount(at, again, len(starts))
    distinct = np.bincount(_distinct(at, h), minlength=len(starts))
    line_hash = _line_hashes(data, starts, ends)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((np.arange(len(row)), line_hash, row))
    seen = np.zeros(len(row), bool)
    if len(row) > 1:
        seen[order[1:]] = (line_hash[order[1:]] == line_hash[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    one = np.maximum(size, 1)
    x = np.stack(
        [
            np.ones(len(size)),
            upper / np.maximum(alpha, 1),
            share(SYMBOL) / one * 4,
            share(BAR) / one * 8,
            share(BANG) / one * 8,
            share(DIGIT) / one,
            share(STOP) / one,
            repeated / np.maximum(n_words, 1),
            1 - distinct / np.maximum(n_words, 1),
            np.log1p(size) / 8,
            seen,
            size == 0,
        ],
        axis=1,
    )
    return x, size, bounds


def _distinct(at: np.ndarray, h: np.ndarray) -> np.ndarray:
    order = np.lexsort((h, at))
    a, b = at[order], h[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[first]


def _line_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    has = ends > starts
    out[has] = tb.hashes(data, starts[has], ends[has])
    return out


def with_neighbours(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Own features, then the previous line's and the next line's (zeros at the ends)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[bounds[:-1]] = 0
    after[bounds[1:] - 1] = 0
    return np.concatenate([x, before, after], axis=1)


def forward_backward(emit: np.ndarray, trans: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(marginals, pair marginals summed over all chains, log partition of each chain)."""
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    begin, size = bounds[:-1][order], size[order]
    steps = int(size[0]) if len(size) else 0
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(steps)]
    alpha, beta = np.array(emit), np.zeros_like(emit)
    for t in range(1, steps):
        i = begin[: live[t]] + t
        alpha[i] += np.logaddexp(alpha[i - 1, :1] + trans[0], alpha[i - 1, 1:] + trans[1])
    for t in range(steps - 1, 0, -1):
        i = begin[: live[t]] + t
        v = emit[i] + beta[i]
        beta[i - 1] = np.logaddexp(v[:, :1] + trans[:, 0], v[:, 1:] + trans[:, 1])
    last = np.zeros(len(order), np.int64)
    last[order] = begin + size - 1
    log_z = np.logaddexp(alpha[last, 0], alpha[last, 1])
    z = np.repeat(log_z, np.diff(bounds))
    marginal = np.exp(alpha + beta - z[:, None])
    inner = np.ones(len(emit), bool)
    inner[bounds[:-1]] = False
    i = np.flatnonzero(inner)
    pair = np.exp(alpha[i - 1][:, :, None] + trans[None] + (emit[i] + beta[i])[:, None, :] - z[i][:, None, None]).sum(axis=0) if len(i) else np.zeros((2, 2))
    return marginal, pair, log_z


def train_crf(x: np.ndarray, y: np.ndarray, bounds: np.ndarray, *, steps: int = 120, rate: float = 0.15, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights (features x 2) and transitions (2 x 2) by Adam on the log-likelihood."""
    theta = np.zeros(x.shape[1] * 2 + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n = len(x)
    truth = np.zeros((n, 2))
    truth[np.arange(n), y] = 1
    inner = np.ones(n, bool)
    inner[bounds[:-1]] = False
    i = np.flatnonzero(inner)
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (y[i - 1], y[i]), 1)
    docs = len(bounds) - 1
    for t in range(1, steps + 1):
        w, trans = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
        marginal, pair, _ = forward_backward(x @ w, trans, bounds)
        grad = np.concatenate([(x.T @ (truth - marginal)).reshape(-1), (pairs - pair).reshape(-1)]) / docs - l2 * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta = theta + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_fit_docs: int = MAX_FIT_DOCS):
    """(weights, transitions), or None without labels, from rows whose crc32(id) mod 5 is not 0."""
    key = F.col(id_col)
    picked = (
        labels.filter(F.col(label_col).isNotNull() & key.isNotNull() & (tb.labelled_part(key, FOLDS) != 0))
        .groupBy(key.alias("_k"))
        .agg(F.min(F.col(label_col).cast("int")).alias("_y"))
        .orderBy(F.xxhash64("_k"), "_k")
        .limit(max_fit_docs)
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tb.slices(batch.column(1)):
                x, _, bounds = line_features(data, offsets)
                yield pa.record_batch([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array([x[bounds[i] : bounds[i + 1]].tobytes() for i in range(b - a)], pa.binary())], names=["k", "y", "x"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((k, y, x) for batch in batches for k, y, x in zip(*(c.to_pylist() for c in (batch.column("k"), batch.column("y"), batch.column("x")))))
        xs = [np.frombuffer(x).reshape(-1, N_OWN) for _, _, x in rows]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in xs])])
        y = np.repeat([min(max(y, 0), 1) for _, y, _ in rows], np.diff(bounds))
        w, trans = train_crf(with_neighbours(np.concatenate(xs), bounds), y, bounds)
        theta = np.concatenate([w.reshape(-1), trans.reshape(-1)])
        yield pa.record_batch([pa.array(np.arange(len(theta))), pa.array(theta)], names=["i", "w"])

    # The picked rows are at most max_fit_docs of two numbers.
    found = docs.select(key.alias("_k"), F.col(text_col).alias("_t")).join(F.broadcast(picked), "_k").filter(F.coalesce(F.octet_length("_t"), F.lit(0)) <= MAX_FIT_BYTES)
    # One text of an id, however often it is repeated: the one that hashes lowest.
    tables = Tables(docs.sparkSession, "quality")
    sample = tables.keep(found.groupBy("_k", "_y").agg(F.min(F.struct(F.xxhash64("_t"), "_t")).alias("_m")).select("_k", "_m._t", "_y"), "sample")
    n_lines = sample.agg(F.sum(F.regexp_count(F.coalesce("_t", F.lit("")), F.lit("\n")) + 1)).first()[0]
    tasks = -(-(n_lines or 0) // LINES_PER_TASK)
    dealt = sample.mapInArrow(extract, f"k {sample.schema['_k'].dataType.simpleString()}, y int, x binary").withColumn("task", F.pmod(F.xxhash64("k"), F.lit(max(1, tasks))))
    fits = dealt.groupBy("task").applyInArrow(train, "i bigint, w double").groupBy("i").agg(F.avg("w").alias("w")).orderBy("i").collect() if tasks else []
    tables.drop_others()
    theta = np.array([r.w for r in fits])
    return (theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)) if fits else None


def score(docs: DataFrame, model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, n_lines, n_good_lines) of every row."""
    frame, text_of = tb.text_input(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tb.slices(text_of(batch)):
                x, size, bounds = line_features(data, offsets)
                if model is None:
                    good = np.ones(len(x))
                else:
                    good = forward_backward(with_neighbours(x, bounds) @ model[0], model[1], bounds)[0][:, 1]
                weight = size + 1.0
                mean = np.add.reduceat(good * weight, bounds[:-1]) / np.add.reduceat(weight, bounds[:-1])
                yield pa.record_batch(
                    [batch.column(0).slice(a, b - a), pa.array(np.clip(mean, 0, 1)), pa.array(np.diff(bounds).astype(np.int64)), pa.array(np.add.reduceat((good >= 0.5).astype(np.int64), bounds[:-1]))],
                    names=["_id", "score", "n_lines", "n_good_lines"],
                )

    return frame.mapInArrow(run, f"_id {frame.schema['_id'].dataType.simpleString()}, score double, n_lines bigint, n_good_lines bigint").withColumnRenamed("_id", id_col)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", (tb.labelled_part(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_lines", "n_good_lines")
