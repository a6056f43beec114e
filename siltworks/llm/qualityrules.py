"""Quality rules: counted base rules, and a calibrated n-gram classifier for the rest.

The base rules count words (runs without ASCII white space), their code points, symbols,
repeated lines and words inside repeated three-word windows of each whole text; texts of
few words or mostly repeated windows fail.  The others are judged by a logistic
regression over hashed word n-grams (one and two words) and character n-grams (four bytes
of UTF-8), each as a share of its kind in the text.  It learns from a bounded sample of labelled rows (``max_fit_docs`` documents of lowest id hash, one text of each,
none of over ``MAX_FIT_BYTES``) whose crc32(id) mod 5 is not 0.

Probabilities are calibrated: each of ``CROSS`` models is fitted without one part of the
sample and scores that part; a line through these scores (Platt) maps the score of the
model of all rows to a probability, which is held against fixed thresholds.  The models
are fitted by as many tasks; only weights and the line, of fixed size, are broadcast.
Whole texts are scored in Arrow batches, one narrow pass.

Defined results: null texts have no words; rows with a null label or id are not learnt
from; of several labels of a document the lowest counts; without labels of both kinds
the probability is that of their share, and 1 without any; columns other than the id and
the text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import textbytes as tb
from siltworks.llm.workspace import Tables

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 50, 3, 50
#: A document stays if it is good with this probability.
THRESHOLD = 0.5
BITS = 18
CHARS = (4,)
#: Labelled documents used for the fit, and the longest text that is learnt from.
MAX_FIT_DOCS, MAX_FIT_BYTES = 2_000, 32 << 10
FOLDS, CROSS = 5, 4
STEPS, RATE, L2 = 60, 0.1, 1e-6
#: Shares of n-grams are small numbers; this brings them to about 1.
SCALE = 30.0

_b = np.arange(256)
IN_WORD = ~((_b == 32) | ((_b >= 9) & (_b <= 13)))
IS_SYMBOL = np.isin(_b, list(SYMBOLS.encode()))
BEGINS_CHAR = (_b & 0xC0) != 0x80
_rng = np.random.Generator(np.random.PCG64(20241103))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_rng.integers(0, 2**63)) * 2 + 1
_LOW = np.array([pow(_BASE, i, 2**64) for i in range(4096)], dtype=np.uint64)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes as it is: a polynomial of the whole run, mixed."""
    size = ends - starts
    out = np.zeros(len(starts), np.uint64)
    has = np.flatnonzero(size > 0)
    if not len(has):
        return out
    first = np.cumsum(size[has]) - size[has]
    at = np.arange(int(size[has].sum()), dtype=np.int64) - np.repeat(first, size[has])
    high = np.array([pow(_BASE, i << 12, 2**64) for i in range(int(size.max() >> 12) + 1)], dtype=np.uint64)
    value = _BYTE[data[at + np.repeat(starts[has], size[has])]] * _LOW[at & 4095]
    if len(high) > 1:
        value *= high[at >> 12]
    out[has] = np.add.reduceat(value, first)
    return tb.mix64(out + size.astype(np.uint64))


def again(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seen before in its row, found twice or more in its row) of each key; rows are sorted."""
    order = np.lexsort((np.arange(len(keys)), keys, rows))
    r, k = rows[order], keys[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = (r[1:] == r[:-1]) & (k[1:] == k[:-1])
    later, often = np.zeros(len(k), bool), np.zeros(len(k), bool)
    later[order] = same[:-1]
    often[order] = same[:-1] | same[1:]
    return later, often


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends = tb.runs(IN_WORD[data], offsets)
    return Words(starts, ends, np.searchsorted(starts, offsets), run_hashes(data, starts, ends))


def base_counts(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """Columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row."""
    n = len(offsets) - 1

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(offsets[:-1], breaks + 1)
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = np.where((ends > starts) & (data[np.maximum(ends - 1, 0)] == 10), ends - 1, ends) if len(data) else ends
    holds = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[holds], ends[holds]
    line_row = np.searchsorted(offsets, starts, side="right") - 1
    later, _ = again(line_row, run_hashes(data, starts, ends))

    count = np.diff(words.bounds)
    row = np.repeat(np.arange(n), count)
    m = max(len(row) - WINDOW + 1, 0)
    inside = row[:m] == row[len(row) - m :]
    key = np.zeros(m, np.uint64)
    for k in range(WINDOW):
        key = tb.mix64(key * np.uint64(0x9E3779B97F4A7C15) + words.hashes[k : k + m])
    at = np.flatnonzero(inside)
    _, often = again(row[at], key[at])
    covered = np.zeros(len(row) + 1, np.int64)
    np.add.at(covered, at[often], 1)
    np.add.at(covered, at[often] + WINDOW, -1)
    covered = np.cumsum(covered)[: len(row)] > 0
    return np.stack([count, total(IN_WORD[data] & BEGINS_CHAR[data]), total(IS_SYMBOL[data]), np.bincount(line_row[later], minlength=n), np.bincount(row[covered], minlength=n)], axis=1)


def failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


def grams(data: np.ndarray, offsets: np.ndarray, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, rows) of each kind of n-gram, repeats included; rows are sorted."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(words.bounds))
    mask = np.uint64((1 << BITS) - 1)
    yield (words.hashes & mask).astype(np.int64), row
    m = max(len(row) - 1, 0)
    inside = row[:m] == row[len(row) - m :]
    pair = tb.mix64(words.hashes[:m] * np.uint64(0x9E3779B97F4A7C15) + words.hashes[len(row) - m :])
    yield (pair[inside] & mask).astype(np.int64), row[:m][inside]
    byte_row = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
    for size in CHARS:
        m = max(len(data) - size + 1, 0)
        key = np.full(m, size, np.uint64)
        for k in range(size):
            key = key * np.uint64(0x100000001B3) + _BYTE[data[k : k + m]]
        inside = byte_row[:m] == byte_row[len(data) - m :]
        yield (tb.mix64(key[inside]) & mask).astype(np.int64), byte_row[:m][inside].astype(np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Model(NamedTuple):
    weight: np.ndarray
    bias: float
    #: Probability = sigmoid(slope * score + offset).
    slope: float
    offset: float

    def probability(self, data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
        n = len(offsets) - 1
        score = np.full(n, self.bias)
        for x, row in grams(data, offsets, words):
            score += SCALE * np.bincount(row, self.weight[x], n) / np.maximum(np.bincount(row, minlength=n), 1)
        return sigmoid(self.slope * score + self.offset)


def shares(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, index, value) of every distinct n-gram of a row, by row and index."""
    n, keys, values = len(offsets) - 1, [], []
    for x, row in grams(data, offsets, words_of(data, offsets)):
        keys.append((row << BITS) + x)
        values.append(SCALE / np.maximum(np.bincount(row, minlength=n), 1)[row])
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key >> BITS, (key & ((1 << BITS) - 1)).astype(np.int32), np.bincount(at, np.concatenate(values), len(key)).astype(np.float32)


def train(row: np.ndarray, x: np.ndarray, value: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the mean log-likelihood of whole passes."""
    used, col = np.unique(x, return_inverse=True)
    w, m, v, n = np.zeros(len(used) + 1), np.zeros(len(used) + 1), np.zeros(len(used) + 1), len(y)
    for t in range(1, STEPS + 1):
        error = y - sigmoid(np.bincount(row, w[:-1][col] * value, n) + w[-1])
        grad = np.append(np.bincount(col, error[row] * value, len(used)), error.sum()) / n - L2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w += RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    whole = np.zeros(1 << BITS)
    whole[used] = w[:-1]
    return whole, float(w[-1])


def line(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's slope and offset by Newton steps, with his targets a little inside 0 and 1."""
    good, n = y.sum(), len(y)
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (n - good + 2))
    theta, x = np.array([1.0, 0.0]), np.stack([score, np.ones(n)], axis=1)

    def loss(t: np.ndarray) -> float:
        z = x @ t
        return float((np.logaddexp(0, z) - target * z).sum())

    for _ in range(100):
        p = sigmoid(x @ theta)
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2)
        step, size = np.linalg.solve(hess, x.T @ (target - p)), 1.0
        while loss(theta + size * step) > loss(theta) and size > 1e-6:
            size /= 2
        theta = theta + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_fit_docs: int = MAX_FIT_DOCS) -> Model:
    """Fit and calibrate on labelled rows whose crc32(id) mod 5 is not 0."""
    key = F.col(id_col)
    picked = (
        labels.filter(F.col(label_col).isNotNull() & key.isNotNull() & (tb.labelled_part(key, FOLDS) != 0))
        .groupBy(key.alias("_k"))
        .agg(F.min(F.col(label_col).cast("int")).alias("_y"))
        .orderBy(F.xxhash64("_k"), "_k")
        .limit(max_fit_docs)
    )
    # The picked rows are at most max_fit_docs of two numbers.
    found = docs.select(key.alias("_k"), F.col(text_col).alias("_t")).join(F.broadcast(picked), "_k").filter(F.octet_length("_t") <= MAX_FIT_BYTES)
    tables = Tables(docs.sparkSession, "qualityrules")
    sample = tables.keep(found.groupBy("_k", "_y").agg(F.min(F.struct(F.xxhash64("_t"), "_t")).alias("_m")).select("_k", "_m._t", "_y"), "sample")
    n, good = sample.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("_y") > 0, 1).otherwise(0)), F.lit(0))).first()
    # Without both kinds there is nothing to tell apart.
    flat = Model(np.zeros(1 << BITS), 0.0, 0.0, float(np.log((good + 1) / (n - good + 1))) if n else 35.0)
    if not 0 < good < n:
        tables.drop_others()
        return flat

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tb.slices(batch.column(1)):
                row, x, value = shares(data, offsets)
                cut = np.searchsorted(row, np.arange(b - a + 1))
                each = [(x[i:j].tobytes(), value[i:j].tobytes()) for i, j in zip(cut, cut[1:])]
                yield pa.record_batch([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), *(pa.array(c, pa.binary()) for c in zip(*each))], names=["k", "y", "x", "v"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((r["k"], r["part"], r["task"], r["y"], r["x"], r["v"]) for batch in batches for r in batch.to_pylist()), key=lambda r: r[0])
        task = rows[0][2]

        def matrix(rows: list) -> tuple:
            x, v = ([np.frombuffer(r[i], t) for r in rows] for i, t in ((4, np.int32), (5, np.float32)))
            return np.repeat(np.arange(len(rows)), [len(a) for a in x]), np.concatenate(x), np.concatenate(v), np.array([float(r[3] > 0) for r in rows])

        own = [r for r in rows if r[1] != task]
        held = [r for r in rows if r[1] == task]
        w, bias = train(*matrix(own)) if own else (np.zeros(1 << BITS), 0.0)
        if task == CROSS:
            at = np.flatnonzero(w)
            yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(w[at], bias)), pa.nulls(len(at) + 1, pa.float64())], names=["i", "w", "y"])
        elif held and own:
            row, x, value, y = matrix(held)
            score = np.bincount(row, w[x] * value, len(y)) + bias
            yield pa.record_batch([pa.array(np.full(len(y), -2)), pa.array(score), pa.array(y)], names=["i", "w", "y"])

    kind = sample.schema["_k"].dataType.simpleString()
    dealt = sample.select("_k", "_t", "_y").mapInArrow(extract, f"k {kind}, y int, x binary, v binary").withColumn("part", F.pmod(F.xxhash64("k"), F.lit(CROSS))).withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(CROSS))))
    # At most 2**BITS weights and as many scores as there are rows in the sample.
    rows = dealt.groupBy("task").applyInArrow(learn, "i bigint, w double, y double").collect()
    tables.drop_others()
    weight, bias = np.zeros(1 << BITS), 0.0
    for r in rows:
        if r.i >= 0:
            weight[r.i] = r.w
        elif r.i == -1:
            bias = r.w
    held = sorted((r.w, r.y) for r in rows if r.i == -2)
    slope, offset = line(np.array([s for s, _ in held]), np.array([y for _, y in held])) if len({y for _, y in held}) == 2 else (1.0, 0.0)
    return Model(weight, bias, slope, offset)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, the counts, base_failed, score, kept) of every row; ``score`` is the probability that it is good."""
    frame, text_of = tb.text_input(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tb.slices(text_of(batch)):
                words = words_of(data, offsets)
                counts = base_counts(data, offsets, words)
                bad, score = failed(counts), shared.value.probability(data, offsets, words)
                columns = [*(pa.array(c) for c in counts.T), pa.array(bad), pa.array(score), pa.array(~bad & (score >= threshold))]
                yield pa.record_batch([batch.column(0).slice(a, b - a), *columns], names=["_id", *COUNTS, "base_failed", "score", "kept"])

    return frame.mapInArrow(run, f"_id {frame.schema['_id'].dataType.simpleString()}, {', '.join(f'{c} bigint' for c in COUNTS)}, base_failed boolean, score double, kept boolean").withColumnRenamed("_id", id_col)


def keep_good(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Documents that pass the rules, in the columns of ``docs``."""
    return judge(tb.as_rows(docs), model, id_col="row", text_col=f"row.{text_col}", threshold=threshold).filter("kept").select("row.*")


def op13_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, model).select("doc_id", *COUNTS, "base_failed", "kept", "score", (tb.labelled_part(F.col("doc_id"), FOLDS) == 0).alias("held_out"))
