"""A Bloom filter of fixed size over integer keys, to spare a shuffle.

It never decides anything: rows that it lets through still meet the real join, and rows
that it stops have keys that are certainly not among the filter's.  Its size is fixed,
so with very many keys it stops less and the join does more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.textbytes import mix64

BITS = 24
HASHES = 4


def _places(keys: np.ndarray) -> list[np.ndarray]:
    h = mix64(keys.astype(np.int64).view(np.uint64))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64((1 << BITS) - 1)).astype(np.int64) for i in range(HASHES)]


def bits_of(keys: DataFrame) -> np.ndarray:
    """The filter's bits, as bytes, for a frame of one bigint column without nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BITS, bool)
        for batch in batches:
            for at in _places(batch.column(0).to_numpy(zero_copy_only=False)):
                bits[at] = True
        packed = np.packbits(bits, bitorder="little").view(np.int64)
        at = np.flatnonzero(packed)
        yield pa.record_batch([pa.array(at), pa.array(packed[at])], names=["word", "bits"])

    words = keys.mapInArrow(run, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    packed = np.zeros(1 << (BITS - 6), np.int64)
    packed[words["word"].to_numpy()] = words["bits"].to_numpy()
    return packed.view(np.uint8)


def may_be_in(keys: DataFrame, column: Column) -> Column:
    """False where the column's value is certainly not one of the keys; a null is not."""
    shared = keys.sparkSession.sparkContext.broadcast(bits_of(keys))

    @F.pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        bits = shared.value
        some = values.notna().to_numpy()
        found = np.zeros(len(values), bool)
        ok = np.ones(int(some.sum()), bool)
        for at in _places(values[some].to_numpy().astype(np.int64)):
            ok &= (bits[at >> 3] >> (at & 7)) & 1 == 1
        found[some] = ok
        return pd.Series(found)

    return test(column)
