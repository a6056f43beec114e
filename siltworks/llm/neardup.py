"""Near-duplicate classes by ProbMinHash, banding and exact verification.

Every text becomes a weighted set of five-word shingles (weight 1 + ln(count)).
ProbMinHash sees each shingle as a Poisson process whose rate is its weight; a
register keeps the shingle with the earliest arrival.  Arrivals after the last
register's time cannot matter, so only arrivals up to a bound are made, and the
bound is raised for the few texts where it was too small: the signature is exact.
Two signatures agree in a register with the probability Jaccard similarity.

Links are judged on sets, so a text that repeats shingles also gets the bands of its set
(all weights 1) in the same buckets; a text without repeats has the same ones already.
Pairs that differ in how often their lines repeat therefore meet as surely as others.

Equal texts meet by a 128-bit hash; one row stands for all of them.  Bands of equal
registers give candidates.  Nothing enumerates a bucket's pairs:

1. each text meets the first text of the buckets it is in, those with most bucket mates
   first; a verified meeting makes that text its parent, and parents of parents are
   followed by doubling;
2. it then meets the first text of each single bucket, where classes still differ;
3. what is left are buckets that hold several classes: their texts meet across
   classes by a prefix filter on the rarest shingles, which leaves out no pair that
   reaches the threshold, so no link is lost behind a first text.

Each meeting is verified on the whole shingle sets (Jaccard >= ``threshold``).  Every
step is a written table of narrow rows, one for a text and not one for a band where that
is possible, and a table goes when its successor is written.

Defined results: equal texts form one class; null and word-less texts have no
shingles and are classes of their own; a text of fewer than five words is one
shingle; a row without an id takes the class of its text where a row with an id has
that text, else none; an id that repeats with several texts has a class for each.
Ids may have any type that can be ordered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm import textbytes as tb
from siltworks.llm.keyfilter import may_be_in
from siltworks.llm.workspace import Tables

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
#: Texts whose arrivals are made at once; each has about registers x (ln(registers) + 3) of them.
SIGNED_AT_ONCE = 256
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n-word shingles and their rows; a shorter text is one shingle."""
    starts, ends, bounds = tb.words(data, offsets)
    h = tb.hashes(data, starts, ends)
    out, rows = tb.ngrams(h, bounds, n)
    size = np.diff(bounds)
    for k in range(1, n):
        short = np.flatnonzero(size == k)
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for j in range(k):
                whole = whole * np.uint64(0x9E3779B97F4A7C15) + h[bounds[short] + j]
            out, rows = np.concatenate([out, tb.mix64(whole ^ np.uint64(k))]), np.concatenate([rows, short])
    return out, rows


def weighted(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shingle, row) with weight 1 + ln(count), ordered by row."""
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(first)
    count = np.diff(np.append(at, len(h)))
    return h[at], rows[at], 1.0 + np.log(count)


def probminhash(h: np.ndarray, rows: np.ndarray, weight: np.ndarray, n_rows: int, m: int) -> np.ndarray:
    """Exact signatures, one row of m shingle hashes each (0 where a row has none)."""
    signature = np.zeros((n_rows, m), np.uint64)
    total = np.bincount(rows, weight, n_rows)
    bound = np.where(total > 0, m * (np.log(m) + 3.0) / np.maximum(total, 1e-300), 0.0)
    todo = total > 0
    while todo.any():
        live = todo[rows]
        sh, sr, sw = h[live], rows[live], weight[live]
        best = np.full((n_rows, m), np.inf)
        times, slots, who = [], [], []
        state, time = sh.copy(), np.zeros(len(sh))
        index = np.arange(len(sh))
        while len(index):
            state = tb.mix64(state + np.uint64(0x9E3779B97F4A7C15))
            u = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            time = time - np.log(u) / sw[index]
            near = time <= bound[sr[index]]
            index, state, time = index[near], state[near], time[near]
            times.append(time)
            slots.append((tb.mix64(state ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.int64) * m >> 32)
            who.append(index)
        t, s, w = np.concatenate(times), np.concatenate(slots), np.concatenate(who)
        key = sr[w] * m + s
        order = np.lexsort((sh[w], t, key))
        key, t, w = key[order], t[order], w[order]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        best.reshape(-1)[key[first]] = t[first]
        signature.reshape(-1)[key[first]] = sh[w[first]]
        full = np.isfinite(best).all(axis=1)
        todo &= ~full
        bound = np.where(todo, bound * 2, bound)
    return signature


def _band_keys(sh: np.ndarray, sr: np.ndarray, w: np.ndarray, n_rows: int, bands: int, rows: int) -> np.ndarray:
    """One key for each row and band."""
    sig = probminhash(sh, sr, w, n_rows, bands * rows).reshape(n_rows, bands, rows)
    key = np.zeros((n_rows, bands), np.uint64)
    for j in range(rows):
        key = tb.mix64(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, j])
    return key


def _band_lists(frame: DataFrame, bands: int, rows: int, n: int) -> DataFrame:
    """(id, x1, x2, bands array<long>) for each row of (id, x1, x2, t) whose text has words.

    A band's key holds its place, so that a bucket is one number.  The bands of the weighted
    set are followed, where the text repeats shingles, by those of the plain set that differ.
    """
    place = tb.mix64(np.arange(1, bands + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tb.slices(batch.column(3), rows=SIGNED_AT_ONCE):
                sh, sr, w = weighted(*shingles(data, offsets, n))
                key = np.zeros((b - a, 2 * bands), np.uint64)
                key[:, :bands] = _band_keys(sh, sr, w, b - a, bands, rows) ^ place
                again = np.bincount(sr, w > 1, minlength=b - a) > 0
                own = again[sr]
                key[again, bands:] = _band_keys(sh[own], (np.cumsum(again) - 1)[sr[own]], np.ones(int(own.sum())), int(again.sum()), bands, rows) ^ place
                listed = np.ones(key.shape, bool)
                listed[:, bands:] = again[:, None] & (key[:, bands:] != key[:, :bands])
                has = np.flatnonzero(np.bincount(sr, minlength=b - a) > 0)
                key, listed = key[has], listed[has]
                ends = np.concatenate([[0], np.cumsum(listed.sum(axis=1))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(key[listed].view(np.int64)))
                yield pa.record_batch([*(c.slice(a, b - a).take(pa.array(has)) for c in batch.columns[:3]), lists], names=["id", "x1", "x2", "bands"])

    return frame.mapInArrow(run, f"id {frame.schema['id'].dataType.simpleString()}, x1 bigint, x2 bigint, bands array<bigint>")


def _overlaps(a: np.ndarray, ta: pa.Array, tb_: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(shared shingles, distinct shingles) of each row's two texts; rows with equal ``a`` in a row share the first text."""
    m = len(a)
    fresh = np.ones(m, bool)
    fresh[1:] = a[1:] != a[:-1]
    at = np.flatnonzero(fresh)
    x, xr, _ = weighted(*shingles(*tb.flat(ta.take(pa.array(at))), n))
    y, yr, _ = weighted(*shingles(*tb.flat(tb_), n))
    # The first text's shingles, once for each row that has it.
    begin = np.searchsorted(xr, np.arange(len(at) + 1))
    which = np.cumsum(fresh) - 1
    size = np.diff(begin)[which]
    first = np.cumsum(size) - size
    index = np.arange(int(size.sum())) + np.repeat(begin[which] - first, size)
    h, r = np.concatenate([x[index], y]), np.concatenate([np.repeat(np.arange(m), size), yr])
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    both = np.bincount(r[1:][(h[1:] == h[:-1]) & (r[1:] == r[:-1])], minlength=m)
    return both, np.bincount(r, minlength=m) - both


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float, n: int) -> DataFrame:
    """The rows of ``pairs`` (a, b, ...) whose whole shingle sets have Jaccard similarity >= threshold.

    Both sides of each join are read from written tables, so Spark can split a text that very many others meet.
    """
    more = [c for c in pairs.columns if c not in ("a", "b")]
    both = pairs.join(texts.select(F.col("k").alias("b"), F.col("t").alias("tb")), "b").join(texts.select(F.col("k").alias("a"), F.col("t").alias("ta")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, *_ in tb.slices(batch.column(1), tb.SLICE_BYTES // 2):
                part = batch.slice(i, j - i)
                shared, total = _overlaps(part.column(2).to_numpy(zero_copy_only=False), part.column(0), part.column(1), n)
                keep = pa.array(np.flatnonzero((shared > 0) & (shared >= threshold * total - 1e-9)))
                yield pa.record_batch([c.take(keep) for c in part.columns[2:]], names=["a", "b", *more])

    return both.select("ta", "tb", "a", "b", *more).mapInArrow(run, ", ".join(f"{c} bigint" for c in ["a", "b", *more]))


def _prefix_pairs(rest: DataFrame, texts: DataFrame, threshold: float, n: int, keep=lambda frame, name: frame) -> DataFrame:
    """Pairs (a, b) of different classes (ca, cb) that can reach the threshold; none that does is left out.

    Prefix filter: with each text's shingles ordered by how few texts hold them, two
    texts that reach the threshold share one of their first size - ceil(threshold x
    size) + 1; their sizes and the shared shingle's places bound the overlap further.
    A shingle that one text alone holds shares nothing, so only its place counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tb.slices(batch.column(1), tb.SLICE_BYTES // 4):
                sh, sr, _ = weighted(*shingles(data, offsets, n))
                size = np.bincount(sr, minlength=b - a)
                take = pa.array(sr)
                yield pa.record_batch([batch.column(0).slice(a, b - a).take(take), batch.column(2).slice(a, b - a).take(take), pa.array(size[sr]), pa.array(sh.view(np.int64))], names=["k", "c", "n", "s"])

    # Written before the next step, so that a task needs one Python worker at a time.
    near = keep(texts.filter(may_be_in(rest.select("k"), F.col("k"))).join(rest, "k").select("k", "t", "c"), "near")
    each = near.mapInArrow(run, "k bigint, c bigint, n bigint, s bigint")
    held = each.groupBy("s").agg(F.count("*").alias("df")).filter("df > 1")
    shared = each.join(held, "s")
    own = Window.partitionBy("k")
    place = shared.withColumn("i", F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("df", "s")) - 1)
    head = place.filter(F.col("i") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9)).select("k", "c", "n", "s", "i")
    p, q = head.alias("p"), head.alias("q")
    most = F.least(F.col("p.n") - F.col("p.i"), F.col("q.n") - F.col("q.i"))
    reach = most >= F.lit(threshold / (1 + threshold)) * (F.col("p.n") + F.col("q.n")) - 1e-9
    met = p.join(q, (F.col("p.s") == F.col("q.s")) & (F.col("p.k") < F.col("q.k")) & (F.col("p.c") != F.col("q.c")) & reach)
    return met.select(F.col("p.k").alias("a"), F.col("q.k").alias("b"), F.col("p.c").alias("ca"), F.col("q.c").alias("cb")).distinct()


def forest_roots(parents: DataFrame, tables: Tables) -> DataFrame:
    """(k, c): the last parent above each key of a forest (k, p), by doubling the steps taken."""
    at = tables.keep(parents.select("k", "p"), "parents-0")
    step = 0
    while True:
        above = at.select(F.col("k").alias("p"), F.col("p").alias("q"))
        step += 1
        moved = tables.keep(at.join(above, "p", "left").select("k", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved")), f"parents-{step}")
        tables.drop(f"parents-{step - 1}")
        at = moved.select("k", "p")
        if moved.filter("moved").isEmpty():
            return at.withColumnRenamed("p", "c")


def components(edges: DataFrame, tables: Tables, name: str) -> DataFrame:
    """(k, c): the smallest key linked to each key that has an edge (a, b).

    Alternates the large-star and small-star steps over written edge tables,
    so no component is gathered anywhere; ends when every edge points to a root.
    """
    both = tables.keep(edges.select(F.greatest("a", "b").alias("k"), F.least("a", "b").alias("c")).filter("k <> c").distinct(), f"{name}-0")
    if both.isEmpty():
        return both
    step = 0
    while True:
        # Large star: neighbours above a key are linked to the smallest neighbour.
        wide = both.union(both.select(F.col("c").alias("k"), F.col("k").alias("c")))
        low = wide.groupBy("k").agg(F.least(F.min("c"), F.col("k")).alias("m"))
        large = wide.join(low, "k").filter("c > k").select(F.col("c").alias("k"), F.col("m").alias("c")).union(low.filter("m < k").select("k", F.col("m").alias("c"))).distinct()
        # Small star: neighbours below a key, and the key, are linked to the smallest.
        least = large.groupBy("k").agg(F.min("c").alias("m"))
        small = large.join(least, "k").select(F.col("c").alias("k"), F.col("m").alias("c")).union(least.select("k", F.col("m").alias("c"))).filter("k <> c").distinct()
        step += 1
        both = tables.keep(small, f"{name}-{step}")
        tables.drop(f"{name}-{step - 1}")
        # Done when each key has one edge and no root has any.
        keys = both.select("k", F.lit(1).alias("n")).union(both.select(F.col("c").alias("k"), F.lit(0).alias("n")).distinct())
        if keys.groupBy("k").agg(F.sum("n").alias("n"), F.min("n").alias("least")).filter("n > 1 or n = 1 and least = 0").isEmpty():
            return both


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, x1, x2, t): the text under a hash of 128 bits."""
    t = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(t).alias("x1"), F.xxhash64(F.lit(7), t).alias("x2"), t.alias("t"))


def text_classes(docs: DataFrame, tables: Tables, *, id_col: str, text_col: str, threshold: float, shingle: int, bands: int, rows: int) -> DataFrame:
    """(x1, x2, id, class_id, class_size, n_links) of each different text with words.

    ``id`` is the smallest id with that text; ``class_id`` the smallest of the class;
    ``class_size`` counts rows and ``n_links`` the verified links that hold the class.
    """
    texts = _hashed(docs, id_col, text_col).filter("id is not null and t is not null")
    once = _band_lists(texts, bands, rows, shingle).groupBy("x1", "x2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("bands").alias("bands"))
    stand = tables.keep(once.withColumn("k", F.monotonically_increasing_id()), "stand")
    long = stand.select("k", F.explode("bands").alias("h"))
    shared = tables.keep(long.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "shared")
    # A text that shares many buckets is near the middle of its group, so the first of a
    # bucket is the one with most bucket mates; the hash of the key settles equals.
    placed = tables.keep(long.join(shared, "h").groupBy("k").agg(F.sum("n").alias("mates"), F.collect_list("h").alias("in")), "placed")
    tables.drop("shared")
    order = F.struct((-F.col("mates")).alias("m"), F.xxhash64("k").alias("x"), F.col("k").alias("f"))
    inside = placed.select("k", order.alias("o"), F.explode("in").alias("h"))
    heads = tables.keep(inside.groupBy("h").agg(F.min("o").alias("o")), "heads")
    met = inside.select("k", "h").join(heads, "h").groupBy("k").agg(F.min("o").alias("o"), F.collect_list(F.struct("h", F.col("o.f").alias("f"))).alias("in"))
    stars = tables.keep(met.select("k", F.col("o.f").alias("f"), "in"), "stars")
    tables.drop("placed", "heads")
    # The texts that meet any other, each once.
    need = stars.select("k").join(stand.select("k", "id", "x1", "x2"), "k")
    own = F.xxhash64("id", "x1")
    texts = texts.filter(may_be_in(need.select(own), own)).groupBy("id", "x1", "x2").agg(F.first("t").alias("t")).join(need, ["id", "x1", "x2"]).select("k", "t")
    texts = tables.keep(texts, "texts")
    first = tables.keep(_verified(stars.filter("k <> f").select(F.col("f").alias("a"), F.col("k").alias("b")), texts, threshold, shingle), "links-1")
    # A first text stands before its followers in the order, so these links are a forest.
    root = forest_roots(first.select(F.col("b").alias("k"), F.col("a").alias("p")), tables)
    # Second meetings: the first text of each bucket, where its class differs.
    labelled = stars.join(root, "k", "left").select("k", F.coalesce("c", "k").alias("c"), F.col("f").alias("was"), F.explode("in").alias("i"))
    others = labelled.select("k", "c", F.col("i.h").alias("h"), F.col("i.f").alias("f"), "was").filter("f <> k")
    apart = others.join(root.select(F.col("k").alias("f"), F.col("c").alias("cf")), "f", "left").withColumn("cf", F.coalesce("cf", "f")).filter("c <> cf")
    apart = tables.keep(apart.select("k", "h", "f", "c", "cf", "was"), "apart")
    second = apart.filter("f <> was").select(F.col("f").alias("a"), F.col("k").alias("b"), F.col("cf").alias("ca"), F.col("c").alias("cb")).distinct()
    again = tables.keep(_verified(second, texts, threshold, shingle), "links-2")
    joined = components(again.select(F.col("ca").alias("a"), F.col("cb").alias("b")), tables, "merged-1")
    root = _renamed(root, joined, "c")
    links = [first.select("a"), again.select("a")]
    # Buckets that still hold several classes: their texts meet across classes.
    mixed = _renamed(_renamed(apart, joined, "c"), joined, "cf").filter("c <> cf").select("h").distinct()
    mixed = tables.keep(mixed, "mixed")
    if not mixed.isEmpty():
        members = stars.select("k", F.explode("in.h").alias("h"))
        members = members.filter(may_be_in(mixed, F.col("h"))).join(mixed, "h", "left_semi").select("k").distinct()
        rest = tables.keep(members.join(_all_roots(stand, root), "k"), "rest")
        across = tables.keep(_prefix_pairs(rest, texts, threshold, shingle, tables.keep), "across")
        tables.drop("near")
        if not across.isEmpty():
            third = tables.keep(_verified(across, texts, threshold, shingle), "links-3")
            joined = components(third.select(F.col("ca").alias("a"), F.col("cb").alias("b")), tables, "merged-2")
            root = _renamed(root, joined, "c")
            links.append(third.select("a"))
    tables.drop("texts", "stars", "apart", "mixed", "rest", "across")
    members = tables.keep(stand.select("k", "id", "x1", "x2", "n").join(_all_roots(stand, root), "k"), "members")
    held = links[0]
    for more in links[1:]:
        held = held.union(more)
    per_text = held.groupBy("a").agg(F.count("*").alias("n_links")).withColumnRenamed("a", "k")
    sums = members.join(per_text, "k", "left").groupBy("c").agg(F.min("id").alias("class_id"), F.sum("n").alias("class_size"), F.sum(F.coalesce("n_links", F.lit(0))).alias("n_links"))
    sums = tables.keep(sums, "sums")
    out = tables.keep(members.join(sums, "c").select("x1", "x2", "id", "class_id", "class_size", "n_links"), "classes")
    tables.drop_others("classes")
    return out


def _all_roots(stand: DataFrame, root: DataFrame) -> DataFrame:
    """(k, c) for every text; one without links is its own root."""
    return stand.select("k").join(root, "k", "left").select("k", F.coalesce("c", "k").alias("c"))


def _renamed(frame: DataFrame, merged: DataFrame, column: str) -> DataFrame:
    """``frame`` with the classes of ``column`` replaced by those they were merged into."""
    to = merged.select(F.col("k").alias(column), F.col("c").alias("_to"))
    return frame.join(to, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")


def classes(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(id, class_id, class_size, n_links) of every row: class_id is the smallest id of the class."""
    tables = Tables(docs.sparkSession, "neardup")
    found = text_classes(docs, tables, id_col=id_col, text_col=text_col, threshold=threshold, shingle=shingle, bands=bands, rows=rows)
    worded = F.coalesce(F.col("t").rlike(WORD), F.lit(False))
    rows_ = _hashed(docs, id_col, text_col)
    named = rows_.filter(worded).select("id", "x1", "x2").join(found.drop("id"), ["x1", "x2"], "left")
    # Texts without words, of which there may be many, meet nothing.
    bare = rows_.filter(~worded).select("id", F.col("id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"), F.lit(0).cast("bigint").alias("n_links"))
    out = named.select("id", "class_id", F.coalesce("class_size", F.lit(1)).cast("bigint").alias("class_size"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")).union(bare)
    return out.withColumnRenamed("id", id_col)


def drop_near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One document of each class, in the columns of ``docs``: that of the smallest id.

    Rows without an id and texts without words stay.  Rows that repeat an id and its text are one document.
    """
    tables = Tables(docs.sparkSession, "neardup")
    found = text_classes(docs, tables, id_col=id_col, text_col=text_col, threshold=threshold, shingle=shingle, bands=bands, rows=rows)
    # Of each class of several rows, the text and id that stay; of equal ids the text that hashes lower.
    several = found.filter("class_size > 1")
    first = several.filter("id = class_id").groupBy("class_id").agg(F.min(F.struct("x1", "x2")).alias("f")).select(F.col("class_id").alias("id"), "f.x1", "f.x2")
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text, key = F.col(f"row.`{text_col}`"), F.col(f"row.`{id_col}`")
    work = work.withColumns({"id": key, "x1": F.xxhash64(text), "x2": F.xxhash64(F.lit(7), text)})
    # Rows that are in no such class stay where they lie.  Of the others the filter names those
    # that stay on narrow rows, so that only their texts are moved, not those of the lost.
    looked = work.filter(key.isNotNull() & text.isNotNull()).filter(may_be_in(several.select("x1"), F.col("x1")))
    alone = looked.select("id", "x1", "x2").join(several.select("x1", "x2"), ["x1", "x2"], "left_anti").select("id", "x1", "x2")
    stay = tables.keep(first.union(alone).distinct(), "stay")
    own = F.xxhash64("id", "x1")
    kept = looked.filter(may_be_in(stay.select(own), own)).join(stay, ["id", "x1", "x2"], "left_semi").groupBy("id", "x1", "x2").agg(F.first("row").alias("row"))
    sure = work.filter(key.isNull() | text.isNull() | ~may_be_in(several.select("x1"), F.col("x1")))
    return sure.select("row").union(kept.select("row")).select("row.*")


def op8_minhash_neardup(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
