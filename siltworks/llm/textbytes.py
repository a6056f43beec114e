"""Vectorised helpers over the UTF-8 bytes of an Arrow string column.

A word is a maximal run of digits, A-Z (lower-cased), a-z and non-ASCII
characters.  In UTF-8 every byte of a non-ASCII character is 0x80 or above, so
words can be cut on bytes without decoding.  All functions work on one slice of
rows that holds a bounded number of bytes; one text is never divided.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_b = np.arange(256)
LOWER = np.where((_b >= 65) & (_b <= 90), _b + 32, _b).astype(np.uint8)
IS_WORD = ((_b >= 48) & (_b <= 57)) | ((_b >= 65) & (_b <= 90)) | ((_b >= 97) & (_b <= 122)) | (_b >= 128)
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(0, 2**64, 1 << 12, dtype=np.uint64) | np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser: a bijection of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary array; a null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    if not len(column):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES, rows: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over runs of at most ``rows`` rows of about ``limit`` bytes."""
    data, offsets = flat(column)
    a, n = 0, len(column)
    while a < n:
        b = min(max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1), a + rows)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values, never across a row's end."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    begin = mask.copy()
    begin[1:] &= ~mask[:-1] | first[1:n]
    end = mask.copy()
    end[:-1] &= ~mask[1:] | first[1:n]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row bounds): words of row i are bounds[i] to bounds[i+1]."""
    starts, ends = runs(IS_WORD[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each lower-cased run of bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
    value = _BYTE[LOWER[data[at + np.repeat(starts, size)]]]
    value *= _PLACE[at & 4095]
    return mix64(np.add.reduceat(value, first) + size.astype(np.uint64))


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """Word hashes of each text; for small tables and tests."""
    data, offsets = flat(pa.array(texts, pa.string()))
    starts, ends, bounds = words(data, offsets)
    h = hashes(data, starts, ends)
    return [h[bounds[i] : bounds[i + 1]] for i in range(len(texts))]


def ngrams(h: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words inside a row, and the row of each."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(h) - n + 1
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + m]
    inside = rows[:m] == rows[n - 1 :]
    return mix64(out[inside]), rows[:m][inside]


def labelled_part(doc_id, modulus: int):
    """crc32 of the id's text, modulo ``modulus``, as a column."""
    from pyspark.sql import functions as F

    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def text_input(docs, key_col: str, text_col: str):
    """(frame, reader): the key and text of ``docs``, and how to find the text in a batch.

    The key may be a struct that holds the text as a field (``text_col`` is then
    ``key.field``); whole rows so travel with their result and the text only once.
    """
    from pyspark.sql import functions as F

    from siltworks.llm.workspace import bounded_batches

    bounded_batches(docs.sparkSession)
    inside = text_col.removeprefix(f"{key_col}.") if text_col.startswith(f"{key_col}.") else None
    frame = docs.select(F.col(key_col).alias("_id"), *([] if inside else [F.col(text_col).alias("_text")]))
    return frame, lambda batch: batch.column(0).field(inside) if inside else batch.column(1)


def as_rows(docs):
    """Each row of ``docs`` as one struct column ``row``."""
    from pyspark.sql import functions as F

    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
