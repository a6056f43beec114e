"""Media columns: payloads in content-defined chunks, deduplicated by digest.

A text's payload is its UTF-8 bytes, filled with spaces to a positive multiple of
192, kept as the samples of an 8-bit greyscale image 192 samples wide (binary PGM).
A rolling gear hash cuts the image's samples into chunks; a chunk's SHA-256 names it.

Storage, in the shared folder:

* digests are counted by Spark, and those that occur more than once set bits of a
  Bloom filter of fixed size (``FILTER_BITS``), which is all that is broadcast;
* chunks outside the filter are certainly unique and stay inside their medium's row;
* all others go to the chunk store, one row per digest, and the row keeps a
  reference.  A false positive only sends a unique chunk the same way.

Reading back joins references with the chunk store, puts the chunks in the order of
the medium's chunk list, checks each digest and the medium's own SHA-256, and only
then hands the bytes on.

Defined results: a null or empty text is one row of 192 spaces; repeated ids are
separate media with chunks in common; ids of any type, null too, are kept as they are; equal
texts give equal values; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import textbytes as tb
from siltworks.llm.workspace import scratch

WIDTH = 192
MIN_CHUNK, MAX_CHUNK = 256, 8192
CUT_BITS = 10
FILTER_BITS = 23
FILTER_HASHES = 4
GEAR = np.random.Generator(np.random.PCG64(19)).integers(0, 2**32, 256, dtype=np.uint32)

STORED = "n_bytes bigint, media_sha256 string, chunks array<struct<digest:binary,size:int,inside:boolean>>, inside binary"
ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}


def header(payload_bytes: int) -> bytes:
    return b"P5\n%d %d\n255\n" % (WIDTH, payload_bytes // WIDTH)


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rows' payloads, one after another, and their offsets."""
    size = np.diff(offsets)
    full = np.maximum(1, -(-size // WIDTH)) * WIDTH
    at = np.concatenate([[0], np.cumsum(full)])
    out = np.full(int(at[-1]), 32, np.uint8)
    for i in np.flatnonzero(size):
        out[at[i] : at[i] + size[i]] = data[offsets[i] : offsets[i + 1]]
    return out, at


def gear_hash(data: np.ndarray) -> np.ndarray:
    """At each byte, the gear hash of the 32 bytes up to it, by doubling the window."""
    h = GEAR[data]
    k = 1
    while k < 32:
        longer = h.copy()
        longer[k:] += h[:-k] << np.uint32(k)
        h = longer
        k *= 2
    return h


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Ends of each row's chunks.  No cut looks over a chunk's start: MIN_CHUNK exceeds the window."""
    cuts = np.flatnonzero(gear_hash(data) >> np.uint32(32 - CUT_BITS) == 0) + 1
    split = np.searchsorted(cuts, offsets, side="right")
    out = []
    for i in range(len(offsets) - 1):
        last, end, ends = int(offsets[i]), int(offsets[i + 1]), []
        for c in [*cuts[split[i] : split[i + 1]].tolist(), end]:
            while c - last > MAX_CHUNK:
                last += MAX_CHUNK
                ends.append(last)
            if c - last >= MIN_CHUNK or c == end and c > last:
                last = c
                ends.append(c)
        out.append(ends)
    return out


def _chunks(column: pa.Array) -> Iterator[tuple[int, memoryview, int, list[tuple[bytes, int, int]]]]:
    """(row, payload, text bytes, [(digest, start, end)]) of each row."""
    for a, b, data, offsets in tb.slices(column):
        flat, at = padded(data, offsets)
        view = memoryview(flat)
        for i, ends in enumerate(chunk_ends(flat, at)):
            starts = [int(at[i]), *ends[:-1]]
            yield a + i, view[at[i] : at[i + 1]], int(offsets[i + 1] - offsets[i]), [(hashlib.sha256(view[s:e]).digest(), s - int(at[i]), e - int(at[i])) for s, e in zip(starts, ends)]


def _bits(digest: bytes) -> list[int]:
    return [int.from_bytes(digest[4 * k : 4 * k + 4], "little") >> (32 - FILTER_BITS) for k in range(FILTER_HASHES)]


def digests(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(digest) of every chunk of every medium, once per medium."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [d for _, _, _, chunks in _chunks(batch.column(0)) for d in {c[0] for c in chunks}]
            yield pa.record_batch([pa.array(found, pa.binary())], names=["digest"])

    return docs.select(F.col(text_col)).mapInArrow(run, "digest binary")


def repeated_filter(found: DataFrame) -> np.ndarray:
    """Bloom filter, as bytes of bits, of the digests that several media hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            for d in batch.column(0):
                bits[_bits(d.as_py())] = True
        packed = np.packbits(bits, bitorder="little").view(np.int64)
        at = np.flatnonzero(packed)
        yield pa.record_batch([pa.array(at), pa.array(packed[at])], names=["word", "bits"])

    twice = found.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    words = twice.mapInArrow(run, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    packed = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    packed[words["word"].to_numpy()] = words["bits"].to_numpy()
    return packed.view(np.uint8)


def store(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the media (``path``/media) and the chunk store (``path``/chunks)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(repeated_filter(digests(docs, text_col)))

    def member():
        bits = shared.value
        return lambda d: all(bits[b >> 3] >> (b & 7) & 1 for b in _bits(d))

    def media(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = member()
        for batch in batches:
            ids = batch.column(0)
            record = partial(_record, ids.type)
            rows: list[tuple] = []
            size = 0
            for i, payload, n, chunks in _chunks(batch.column(1)):
                flags = [not known(d) for d, _, _ in chunks]
                whole = hashlib.sha256(header(len(payload)))
                whole.update(payload)
                inside = b"".join(payload[s:e] for (_, s, e), f in zip(chunks, flags) if f)
                rows.append((ids[i].as_py(), n, whole.hexdigest(), [{"digest": d, "size": e - s, "inside": f} for (d, s, e), f in zip(chunks, flags)], inside))
                size += len(inside)
                if size > tb.SLICE_BYTES:
                    yield record(rows)
                    rows, size = [], 0
            yield record(rows)

    def _record(id_type: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 5
        kinds = [id_type, pa.int64(), pa.string(), pa.list_(pa.struct([("digest", pa.binary()), ("size", pa.int32()), ("inside", pa.bool_())])), pa.binary()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_bytes", "media_sha256", "chunks", "inside"])

    def shared_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = member()
        for batch in batches:
            seen: dict[bytes, bytes] = {}
            for _, payload, _, chunks in _chunks(batch.column(0)):
                for d, s, e in chunks:
                    if d not in seen and known(d):
                        seen[d] = bytes(payload[s:e])
            yield pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.binary())], names=["digest", "bytes"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    packed = rows.mapInArrow(media, f"doc_id {id_type(docs, id_col)}, {STORED}").withColumn("uid", F.monotonically_increasing_id())
    packed.write.option("compression", "zstd").parquet(f"{path}/media")
    once = rows.select("t").mapInArrow(shared_chunks, "digest binary, bytes binary").dropDuplicates(["digest"])
    once.write.option("compression", "zstd").parquet(f"{path}/chunks")


def id_type(docs: DataFrame, id_col: str = "doc_id") -> str:
    """Type of the id column as SQL names it; media keep it."""
    return docs.select(id_col).schema[0].dataType.simpleString()


def read_back(spark, path: str, *, reader, of_type: str = "bigint") -> DataFrame:
    """Rows of ``reader(row, media bytes)`` for every stored medium, verified.

    ``reader`` is a pair (function, schema); the function gets doc_id, n_bytes and the
    medium's bytes and returns a tuple in the schema's order.  ``of_type`` is the stored ids' type.
    """
    function, schema = reader
    media = spark.read.schema(f"uid bigint, doc_id {of_type}, {STORED}").parquet(f"{path}/media")
    chunks = spark.read.schema("digest binary, bytes binary").parquet(f"{path}/chunks")
    outside = F.exists("chunks", lambda c: ~c["inside"])
    fields = [x.split(maxsplit=1) for x in schema.split(", ")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            out = []
            for row in batch.to_pylist():
                held = {c["digest"]: c["bytes"] for c in row.get("held") or []}
                parts, at = [], 0
                for c in row["chunks"]:
                    if c["inside"]:
                        part = row["inside"][at : at + c["size"]]
                        at += c["size"]
                    else:
                        part = held.get(c["digest"])
                        if part is None:
                            raise ValueError(f"a chunk of document {row['doc_id']} is lost")
                    if hashlib.sha256(part).digest() != c["digest"]:
                        raise ValueError(f"a chunk of document {row['doc_id']} is damaged")
                    parts.append(part)
                payload = b"".join(parts)
                medium = header(len(payload)) + payload
                if hashlib.sha256(medium).hexdigest() != row["media_sha256"]:
                    raise ValueError(f"the medium of document {row['doc_id']} is damaged")
                out.append(function(row["doc_id"], row["n_bytes"], medium))
            if out:
                yield pa.record_batch([pa.array(c, ARROW.get(kind)) for c, (_, kind) in zip(zip(*out), fields)], names=[n for n, _ in fields])

    kept = ["doc_id", "n_bytes", "media_sha256", "chunks", "inside"]
    complete = media.filter(~outside).select(*kept).mapInArrow(build, schema)
    part = media.filter(outside)
    wanted = part.select("uid", F.explode(F.array_distinct(F.expr("transform(filter(chunks, c -> not c.inside), c -> c.digest)"))).alias("digest"))
    held = wanted.join(chunks, "digest").groupBy("uid").agg(F.collect_list(F.struct("digest", "bytes")).alias("held"))
    joined = part.join(held, "uid", "left").select(*kept, "held").mapInArrow(build, schema)
    return complete.unionByName(joined)


def features(samples: np.ndarray) -> str:
    """Mean, deviation, mean steps along and across rows, and an 8-bin histogram of the samples."""
    x = samples.reshape(-1, WIDTH).astype(np.int32)
    across = np.abs(np.diff(x, axis=0)).mean() if len(x) > 1 else 0.0
    bins = np.bincount(samples >> 5, minlength=8)
    return f"{x.mean():.4f};{x.std():.4f};{np.abs(np.diff(x, axis=1)).mean():.4f};{across:.4f};" + ",".join(map(str, bins))


def describe(doc_id, n_bytes: int, medium: bytes) -> tuple:
    """The contract's values, all from the bytes that were read back."""
    at = 0
    for _ in range(3):
        at = medium.index(b"\n", at) + 1
    payload = medium[at:]
    return doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(medium), hashlib.sha256(medium).hexdigest(), features(np.frombuffer(payload, np.uint8))


DESCRIBED = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"


def described(of_type: str) -> str:
    """``DESCRIBED`` with ids of another type."""
    return f"doc_id {of_type}, {DESCRIBED.split(', ', 1)[1]}"


def op4_media_chunks(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "media")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    store(docs, path)
    return read_back(spark, path, reader=(describe, described(id_type(docs))), of_type=id_type(docs))
