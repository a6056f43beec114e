"""Prefix trie of conversations, read off the sorted sequences' common prefixes.

A conversation is the sequence of its turns' digests.  The sequences are sorted over
the whole table, and each neighbour pair's common prefix length (LCP) is taken.  The
Cartesian tree of these lengths has the trie's branching nodes: an interval of sorted
conversations between the nearest smaller LCP on either side shares a prefix as long as
its smallest LCP, intervals of equal LCP are one node, and the depths between an
interval and its parent's are nodes with the same members.

Nearest smaller values are found in parallel.  Every partition of the sort (a block)
scans its rows with a stack of LCP values and settles the intervals that lie inside it.
What reaches its edges remains: the falling minima from the left edge, the block's
minimum, the rising values up to the right edge, all prefixes of its first or last
sequence.  Such remainders are joined ``FAN`` neighbours at a time until one is left, so
no task sees more than ``FAN`` of them and nothing of the kind goes to the driver.
Sums over an interval are kept on its stack entry and aggregate upwards as it closes.

Ids of equal conversations stand together after the sort; a group that touches an edge
of a block is hashed from pieces in order, as a stream.

Defined results: a null role or text is empty; rows without a conv_id belong to no
conversation; turns are ordered nulls first, rows of one turn by the digest of role and
text; an empty table has no nodes; further columns are never read.  A conversation is
one row of 40 bytes a turn on its way to the sort; texts are read once and not moved.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.workspace import Tables

#: Bytes of a turn's digest.
WIDTH = 16
#: Remainders of blocks that are joined in one task.
FAN = 64
#: Bytes of ids in one piece of a group.
PIECE = 1 << 20
ROWS = 4096
#: Turns that a rebuilt conversation may take from the first of its group of ``GROUP``.
GROUP, HEADS = 5, 9
NO_ENDS = hashlib.sha256(b"").hexdigest()

SCHEMA = "kind string, block bigint, own binary, parent binary, lo bigint, hi bigint, conv_id bigint, n bigint, shared bigint, before array<bigint>, kids bigint, leaves bigint, ends string, blob binary, piece bigint"
ARROW = pa.schema(
    [("kind", pa.string()), ("block", pa.int64()), ("own", pa.binary()), ("parent", pa.binary()), ("lo", pa.int64()), ("hi", pa.int64()), ("conv_id", pa.int64()), ("n", pa.int64()), ("shared", pa.int64())]
    + [("before", pa.list_(pa.int64())), ("kids", pa.int64()), ("leaves", pa.int64()), ("ends", pa.string()), ("blob", pa.binary()), ("piece", pa.int64())]
)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's array of (turn, digest, bytes) in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    rows = turns.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("conv_id"), F.struct(F.col("turn"), digest.alias("digest"), F.octet_length(text).cast("bigint").alias("bytes")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversation c with its first h turns taken from c - c % 5; h = crc32(c) % 9.

    Only the first eight turns of every fifth conversation are joined to its group.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    heads = convs.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    both = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).withColumn("h", h).join(heads, "base", "left")
    taken = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return both.select("conv_id", F.concat(taken, rest).alias("turns"))


def common(a: bytes, b: bytes) -> int:
    """Whole digests that two sequences have in common at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    lo, step = 0, WIDTH
    while a[lo : lo + step] == b[lo : lo + step]:
        lo, step = lo + step, 2 * step
    while step > WIDTH:
        step //= 2
        if a[lo : lo + step] == b[lo : lo + step]:
            lo += step
    return lo // WIDTH


def name_of(key: bytes, depth: int) -> bytes:
    """Names the node at a depth of a sequence."""
    return hashlib.sha256(key[: depth * WIDTH]).digest()[:WIDTH]


class Entry:
    """An interval on the stack, without what its children still hold."""

    __slots__ = ("depth", "ends", "kids", "leaves", "least", "n", "shared")

    def __init__(self, depth: int, least: int | None = None):
        self.depth, self.least, self.n = depth, least, int(least is not None)
        #: Bytes that each member but the first shares with the one before it, summed.
        self.shared = self.kids = self.leaves = 0
        #: Null: nobody ends here; "*": the ids are in pieces; else their hash.
        self.ends: str | None = None

    def take(self, other: Entry) -> None:
        self.n += other.n
        self.shared += other.shared
        if other.least is not None:
            self.least = other.least if self.least is None else min(self.least, other.least)

    def add(self, other: Entry) -> None:
        """The same node, seen from another block."""
        self.take(other)
        self.kids += other.kids
        self.leaves += other.leaves
        self.ends = self.ends or other.ends


class Run:
    """Neighbouring sorted sequences: settled intervals go out, the others stay open."""

    def __init__(self, whole: bool = False):
        self.first: tuple[bytes, list[int]] | None = None
        self.last: tuple[bytes, list[int]] = (b"", [0])
        #: Open to the left, deepest first; then open[0] touches both edges, the rest the right one.
        self.left: list[Entry] = []
        self.open: list[Entry] = [Entry(0)] if whole else []
        self.out: list[tuple] = []

    def settle(self, e: Entry, lo: int) -> None:
        key, sums = self.last
        before = [sums[max(d - 1, 0)] for d in range(lo, e.depth + 1)] if e.n > 1 else None
        self.out.append(("node", None, name_of(key, e.depth), name_of(key, lo - 1) if lo else None, lo, e.depth, e.least, e.n, e.shared, before, e.kids, e.leaves or 1, e.ends, None, None))

    def cut(self, depth: int) -> Entry:
        """Ends the intervals deeper than ``depth`` and returns the one of that depth."""
        stack = self.open
        while stack[-1].depth > depth:
            e = stack.pop()
            if not stack:
                self.left.append(e)
                stack.append(Entry(depth))
                break
            lo = max(stack[-1].depth, depth)
            self.settle(e, lo + 1)
            if stack[-1].depth < depth:
                stack.append(Entry(depth))
            stack[-1].take(e)
            stack[-1].kids += 1
            stack[-1].leaves += e.leaves or 1
        return stack[-1]

    def push(self, row: tuple[bytes, list[int]], e: Entry) -> Entry:
        """The next sequence, whose own node is ``e``; returns the entry that now stands for it."""
        if self.first is None and not self.open:
            self.first = self.last = row
            self.open.append(e)
            return e
        q = common(self.last[0], row[0])
        top = self.cut(q)
        if self.first is not None or top.n:
            top.shared += row[1][q]
        self.first = self.first or row
        self.last = row
        if e.depth == q:
            top.add(e)
            return top
        self.open.append(e)
        return e

    def join(self, other: Run) -> None:
        """Appends the run that follows."""
        if not self.open:
            self.first, self.last, self.left, self.open = other.first, other.last, other.left, other.open
            return
        falling = [*other.left, other.open[0]]
        self.push(other.first, falling[0])
        for e in falling[1:]:
            self.cut(e.depth).add(e)
        self.open += other.open[1:]
        self.last = other.last

    def close(self) -> None:
        """Ends everything; for a run made with ``whole``."""
        self.settle(self.cut(0), 0)

    def remainder(self) -> bytes:
        entries = [[tuple(getattr(e, s) for s in Entry.__slots__) for e in part] for part in (self.left, self.open)]
        return pickle.dumps((self.first, self.last, *entries))

    @classmethod
    def of(cls, blob: bytes) -> Run:
        run = cls()
        run.first, run.last, *parts = pickle.loads(blob)
        for part, into in zip(parts, (run.left, run.open)):
            for values in part:
                e = Entry(0)
                for s, v in zip(Entry.__slots__, values):
                    setattr(e, s, v)
                into.append(e)
        return run


def batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[a : a + ROWS]), ARROW)], schema=ARROW)


def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block in order: its settled nodes, pieces of ids at its edges and its remainder."""
    run, at, group, ids, size, pieces, inner = Run(), None, None, [], 0, 0, False

    def flush() -> None:
        nonlocal ids, size, pieces
        run.out.append(("ends", at, name_of(run.last[0], len(run.last[0]) // WIDTH), *[None] * 9, ",".join(ids), None, pieces))
        ids, size, pieces = [], 0, pieces + 1

    for batch in rows:
        for block, key, sizes, conv in zip(*(c.to_pylist() for c in batch.columns)):
            same = group is not None and key == run.last[0]
            if group is not None and not same:
                if inner and not pieces:
                    group.ends = hashlib.sha256(",".join(ids).encode()).hexdigest()
                else:
                    group.ends = "*"
                    if ids:
                        flush()
                inner, ids, size, pieces = True, [], 0, 0
            at = block
            group = run.push((key, [0, *accumulate(sizes)]), Entry(len(key) // WIDTH, conv))
            ids.append(str(conv))
            size += len(ids[-1]) + 1
            if size >= PIECE:
                flush()
        if len(run.out) >= ROWS:
            yield from batches(run.out)
            run.out = []
    if group is not None:
        group.ends = "*"
        if ids:
            flush()
        yield from batches([*run.out, ("open", at, *[None] * 11, run.remainder(), None)])


def joiner(whole: bool):
    def joined(table: pa.Table) -> pa.Table:
        """The remainders of neighbouring blocks as one, and the nodes that this settles."""
        run = Run(whole)
        rows = sorted(zip(table.column("block").to_pylist(), table.column("blob").to_pylist()))
        for _, blob in rows:
            run.join(Run.of(blob))
        if whole:
            run.close()
        else:
            run.out.append(("open", rows[0][0] // FAN, *[None] * 11, run.remainder(), None))
        return pa.Table.from_batches(list(batches(run.out)), ARROW)

    return joined


def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each node's pieces, which come in order; holds one piece at a time."""
    own, digest = None, None
    for batch in rows:
        for key, text in zip(*(batch.column(i).to_pylist() for i in (0, 3))):
            if key != own:
                if own is not None:
                    yield pa.record_batch([pa.array([own], pa.binary()), pa.array([digest.hexdigest()])], names=["own", "hash"])
                own, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
    if own is not None:
        yield pa.record_batch([pa.array([own], pa.binary()), pa.array([digest.hexdigest()])], names=["own", "hash"])


def prefix_trie(convs: DataFrame) -> DataFrame:
    """A row for each node of the trie of (conv_id, turns), ``turns`` as ``sequences`` gives them."""
    spark = convs.sparkSession
    tables = Tables(spark, "prefixtrie")
    keyed = tables.keep(convs.select(F.unhex(F.array_join("turns.digest", "")).alias("key"), F.col("turns.bytes").alias("bytes"), "conv_id"), "keyed")
    ordered = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    level = tables.keep(ordered.select(F.spark_partition_id().cast("bigint").alias("block"), "key", "bytes", "conv_id").mapInArrow(scan, SCHEMA), "blocks")
    tables.drop("keyed")
    ends = level.filter("kind = 'ends'").select("own", "block", "piece", "ends")
    nodes = [level.filter("kind = 'node'")]
    n = level.filter("kind = 'open'").agg(F.max("block")).first()[0] or 0
    for step in range(64):
        part = (F.col("block") / FAN).cast("bigint")
        whole = n < FAN
        frame = level.filter("kind = 'open'").select("block", "blob").groupBy(part).applyInArrow(joiner(whole), SCHEMA)
        level = tables.keep(frame, f"joined-{step}")
        nodes.append(level.filter("kind = 'node'"))
        n //= FAN
        if whole:
            break
    found = reduce(DataFrame.unionAll, nodes).drop("kind", "block", "blob", "piece")
    hashes = ends.repartition("own").sortWithinPartitions("own", "block", "piece").mapInArrow(hashed, "own binary, hash string")
    parents = found.select(F.col("own").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    rows = found.join(parents, "parent", "left").join(hashes.withColumnRenamed("own", "ended"), (F.col("own") == F.col("ended")) & (F.col("ends") == "*"), "left")
    last = F.col("depth") == F.col("hi")
    return rows.withColumn("depth", F.explode(F.sequence("lo", "hi"))).select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > F.col("lo"), F.col("conv_id")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("kids")).otherwise(F.lit(1)).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.when(F.col("n") > 1, F.col("shared") - (F.col("n") - 1) * F.element_at("before", (F.col("depth") - F.col("lo") + 1).cast("int"))).otherwise(F.lit(0)).cast("bigint").alias("saved_tokens"),
        F.when(last & F.col("ends").isNotNull(), F.coalesce("hash", "ends")).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


#: CRC-32 of a decimal number's text, bit by bit.
SQL_CRC = """xor(list_reduce(range(0, 8 * length({s})), lambda c, k: xor(xor(c, CASE WHEN k % 8 = 0 THEN ascii(substr({s}, (k // 8 + 1)::int, 1)) ELSE 0 END) >> 1,
  3988292384 * (xor(c, CASE WHEN k % 8 = 0 THEN ascii(substr({s}, (k // 8 + 1)::int, 1)) ELSE 0 END) & 1)), 4294967295), 4294967295)"""

OP11_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS digest, strlen(coalesce(text, '')) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'d': digest, 'b': bytes}} ORDER BY turn NULLS FIRST, digest) AS t, {SQL_CRC.format(s="conv_id::varchar")} % 9 AS h
  FROM turns GROUP BY conv_id),
whole AS (
  SELECT a.conv_id, list_concat(coalesce(b.t[1:a.h], []), a.t[a.h + 1:]) AS t
  FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
walked AS (
  SELECT conv_id, len(t) AS size, d, list_transform(t[1:d], lambda x: x.d) AS p, CASE WHEN d > 0 THEN t[d].b ELSE 0 END AS bytes
  FROM whole, unnest(range(0, len(t) + 1)) AS u(d)),
node AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (WHERE size = d), '')) AS ends
  FROM walked GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS k FROM node WHERE d > 0 GROUP BY 1),
sums AS (
  SELECT n.p[1:u.a] AS p, sum((n.n - 1) * n.bytes) AS saved, count(*) FILTER (WHERE k.k IS NULL) AS leaves
  FROM node n LEFT JOIN kids k ON k.p = n.p, unnest(range(0, n.d + 1)) AS u(a) GROUP BY 1)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k.k, 0) AS n_children, s.leaves AS n_leaves,
  s.saved::bigint AS saved_tokens, n.ends AS ends_sha256
FROM node n JOIN sums s ON s.p = n.p LEFT JOIN kids k ON k.p = n.p LEFT JOIN node up ON n.d > 0 AND up.p = n.p[1:n.d - 1]
"""
