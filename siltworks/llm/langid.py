"""Language identification by inference of a document's mixture of languages.

Character trigrams inside words are counted per language over all labelled rows
(dense hashed counters in each task, summed by Spark).  A word's likelihood under a
language is the product of its trigrams'; expectation-maximisation over a document's
words gives its language proportions, and the set of languages is the one whose
log-likelihood less ``penalty`` x size x ln(words) is the highest; sets grow by the next
largest share until the penalty alone forbids another language.

Defined results: a text that is null or has no letter is ``und`` with score 0, and
so is every text when no row is labelled; ties go to the smaller language name; a
null language is never learnt.  What is broadcast is 2**BITS numbers per language,
and more than ``MAX_LANGUAGES`` languages are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import textbytes as tb

BITS = 15
FOLDS = 4
HELD_OUT = 2
MAX_LANGUAGES = 400
ROUNDS = 8
PENALTY = 2.0

_b = np.arange(256)
#: Letters keep their lower-case byte; everything else is a space.
LETTER = np.where((_b >= 128) | ((tb.LOWER >= 97) & (tb.LOWER <= 122)), tb.LOWER, 32).astype(np.uint8)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indices, word starts in them, words per row bounds) of the letters' trigrams."""
    low = LETTER[data]
    starts, ends = tb.runs(low != 32, offsets)
    if not len(starts):
        return np.zeros(0, np.int32), starts, np.zeros(len(offsets), np.int64)
    size = ends - starts
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum()), dtype=np.int64) + np.repeat(starts - first, size)
    mid = low[at].astype(np.uint32)
    before = np.concatenate([[32], mid[:-1]]).astype(np.uint32)
    before[first] = 32
    after = np.concatenate([mid[1:], [32]]).astype(np.uint32)
    after[first + size - 1] = 32
    gram = ((before << np.uint32(16)) | (mid << np.uint32(8)) | after) * np.uint32(2654435761)
    return (gram >> np.uint32(32 - BITS)).astype(np.int32), first, np.searchsorted(starts, offsets)


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities[trigram, language]) from rows whose crc32(id) mod 4 is not 2."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).dictionary_encode()
            code, names = langs.indices.to_numpy(zero_copy_only=False), langs.dictionary.to_pylist()
            for a, b, data, offsets in tb.slices(batch.column(0)):
                gram, first, bounds = trigrams(data, offsets)
                if not len(gram):
                    continue
                word_row = np.repeat(np.arange(b - a), np.diff(bounds))
                row = np.repeat(word_row, np.diff(np.append(first, len(gram))))
                seen = np.bincount(code[a:b][row].astype(np.int64) * (1 << BITS) + gram, minlength=len(names) << BITS).reshape(-1, 1 << BITS)
                for k in np.flatnonzero(seen.any(axis=1)):
                    total[names[k]] = total.get(names[k], 0) + seen[k]
        for name, x in total.items():
            at = np.flatnonzero(x)
            yield pa.record_batch([pa.array([name] * len(at)), pa.array(at), pa.array(x[at])], names=["lang", "g", "n"])

    key = F.col(id_col)
    learn = docs.filter(key.isNotNull() & F.col(lang_col).isNotNull() & (tb.labelled_part(key, FOLDS) != HELD_OUT)).select(F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    names = sorted(r.l for r in learn.select("l").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    got = learn.mapInArrow(count, "lang string, g bigint, n bigint").groupBy("lang", "g").agg(F.sum("n").alias("n")).toArrow()
    index = {x: i for i, x in enumerate(names)}
    counts = np.zeros((1 << BITS, len(names)))
    if got.num_rows:
        counts[got["g"].to_numpy(), [index[x] for x in got["lang"].to_pylist()]] = got["n"].to_numpy()
    return names, np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * (1 << BITS))).astype(np.float32)


def _em(like: np.ndarray, row: np.ndarray, first: np.ndarray, n: np.ndarray, pi: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each row with words, and its log-likelihood."""
    for _ in range(rounds):
        part = like * pi[row]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-30)
        pi = np.add.reduceat(part, first, axis=0) / n[:, None]
    return pi, np.add.reduceat(np.log(np.maximum((like * pi[row]).sum(axis=1), 1e-30)), first)


def mixture(log_p: np.ndarray, data: np.ndarray, offsets: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Language proportions of each row over its selected languages; zeros without words."""
    out = np.zeros((len(offsets) - 1, log_p.shape[1]), np.float32)
    gram, first, bounds = trigrams(data, offsets)
    n_all = np.diff(bounds)
    has = np.flatnonzero(n_all)
    if not len(has) or not log_p.shape[1]:
        return out
    # A few languages at a time: each takes a number for every trigram.
    word = np.concatenate([np.add.reduceat(log_p[:, k : k + 16][gram], first, axis=0) for k in range(0, log_p.shape[1], 16)], axis=1)
    like = np.exp(np.maximum(word - word.max(axis=1, keepdims=True), -60))
    n = n_all[has]
    row = np.repeat(np.arange(len(has)), n)
    at = bounds[has]
    full, _ = _em(like, row, at, n, np.full((len(has), log_p.shape[1]), 1 / log_p.shape[1], np.float32), ROUNDS)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
    best, best_value = None, None
    live = np.arange(len(has))
    for k in range(1, log_p.shape[1] + 1):
        if best is not None:
            # No likelihood exceeds 1, so a set whose penalty alone is worse than the best value is forbidden.
            live = live[best_value[live] < -penalty * k * np.log(n[live] + 1.0)]
            if not len(live):
                break
        mine = np.isin(row, live) if len(live) < len(has) else np.ones(len(row), bool)
        own_n = n[live]
        own_row = np.repeat(np.arange(len(live)), own_n)
        own_at = np.cumsum(own_n) - own_n
        pi = np.where(rank[live] < k, full[live], 0)
        pi /= np.maximum(pi.sum(axis=1, keepdims=True), 1e-30)
        pi, value = _em(like[mine], own_row, own_at, own_n, pi.astype(np.float32), 0 if k == 1 else 3)
        value = value - penalty * k * np.log(own_n + 1.0)
        if best is None:
            best, best_value = pi, value
        else:
            better = value > best_value[live]
            best[live[better]], best_value[live[better]] = pi[better], value[better]
    out[has] = best
    return out


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, mixture): the largest share and all selected languages with theirs."""
    frame, text_of = tb.text_input(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, log_p = shared.value
        for batch in batches:
            texts = text_of(batch)
            for a, b, data, offsets in tb.slices(texts, max(1 << 14, tb.SLICE_BYTES * 8 // max(8, len(names)))):
                pi = mixture(log_p, data, offsets)
                ascii_letters = np.concatenate([[0], np.cumsum((LETTER[data] != 32) & (data < 128), dtype=np.int64)])
                sure = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
                for i in np.flatnonzero(~sure & (pi.sum(axis=1) > 0)):
                    if not any(map(str.isalpha, texts[a + int(i)].as_py() or "")):
                        pi[i] = 0
                top = pi.argmax(axis=1) if len(names) else np.zeros(b - a, int)
                share = pi[np.arange(b - a), top].astype(float) if len(names) else np.zeros(b - a)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([names[t] if s > 0 else "und" for t, s in zip(top, share)], pa.string()),
                        pa.array(np.clip(share, 0, 1)),
                        pa.array([[(names[k], float(p[k])) for k in np.flatnonzero(p)] for p in pi], pa.map_(pa.string(), pa.float64())),
                    ],
                    names=["_id", "lang_pred", "score", "mixture"],
                )

    return frame.mapInArrow(run, f"_id {frame.schema['_id'].dataType.simpleString()}, lang_pred string, score double, mixture map<string,double>").withColumnRenamed("_id", id_col)


def op7_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(docs, fit(docs))
    return found.select("doc_id", (tb.labelled_part(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
