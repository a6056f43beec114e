"""Benchmark decontamination with a generalised suffix automaton.

The benchmark's items are dealt by hash into blocks of about ``BLOCK_WORDS`` words.
One block at a time reaches the driver and is broadcast, a task builds its automaton
once, and training text streams through it and keeps the longest matching length at
each word.  A benchmark of one block takes one pass; a larger one takes a pass for
each block, and every pass adds to what the one before it found and is written.

Defined results: a null or word-less text has no words and no hits; an item
without words is ignored; repeated items each count under their own id; items
with a null id match but are not named; other columns pass through untouched
under any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import textbytes as tb
from siltworks.llm.workspace import Tables

WINDOW = 13
BLOCK_WORDS = 400_000


class Automaton:
    """Suffix automaton of all items of a block, with the windows that count."""

    def __init__(self, items: list[tuple[int, np.ndarray]], window: int = WINDOW):
        self.window = window
        self.vocab = np.unique(np.concatenate([x for _, x in items])) if items else np.zeros(0, np.uint64)
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        walks = []
        for k, (_, hashed) in enumerate(items):
            tokens = np.searchsorted(self.vocab, hashed).tolist()
            last = 0
            for t in tokens:
                last = self._extend(last, t)
            walks.append((k, tokens))
        self.items: list[set[int]] = [set() for _ in self.length]
        self.whole: list[list[tuple[int, int]]] = [[] for _ in self.length]
        for k, tokens in walks:
            v = 0
            for t in tokens:
                v = u = self.next[v][t]
                while u > 0 and k not in self.items[u]:
                    self.items[u].add(k)
                    u = self.link[u]
            if 0 < len(tokens) < window:
                self.whole[v].append((len(tokens), k))
        self.shortest = min([window, *(len(t) for _, t in walks if t)])
        # Nearest ancestor that ends a whole short item.
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        self.up = [0] * len(self.length)
        for v in order:
            p = self.link[v]
            self.up[v] = p if self.whole[p] else self.up[p]

    def _extend(self, last: int, t: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if t in nxt[last]:
            q = nxt[last][t]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, t, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and t not in nxt[p]:
            nxt[p][t] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][t]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, t, q)
        return cur

    def _clone(self, p: int, t: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = c
        while p >= 0 and nxt[p].get(t) == q:
            nxt[p][t] = c
            p = link[p]
        return c

    def stream(self, tokens: list[int]) -> tuple[list[tuple[int, int]], set[int], int]:
        """(start, end) of each window occurrence, items seen, longest match."""
        nxt, link, length, window, whole, up = self.next, self.link, self.length, self.window, self.whole, self.up
        found: list[tuple[int, int]] = []
        seen: set[int] = set()
        most = v = n = 0
        for i, t in enumerate(tokens):
            to = nxt[v].get(t)
            while to is None and v:
                v = link[v]
                n = length[v]
                to = nxt[v].get(t)
            if to is None:
                continue
            v, n = to, n + 1
            if n > most:
                most = n
            if n >= window:
                found.append((i + 1 - window, i + 1))
                u = v
                while length[link[u]] >= window:
                    u = link[u]
                seen |= self.items[u]
            u = v if whole[v] else up[v]
            while u:
                for size, k in whole[u]:
                    if size <= n:
                        found.append((i + 1 - size, i + 1))
                        seen.add(k)
                u = up[u]
        return found, seen, most


def _items(rows: list[tuple]) -> list[tuple[str | None, np.ndarray]]:
    """The items of one block that have words."""
    return [(item, hashed) for (item, _), hashed in zip(rows, tb.word_hashes([t for _, t in rows])) if len(hashed)]


def _merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


SPANS = "array<struct<start:bigint,end:bigint>>"


def _pass(frame: DataFrame, text_of, items: list, window: int) -> DataFrame:
    """``frame`` with what one block's items add to its last four columns (longest, spans, spans_bytes, items)."""
    shared = frame.sparkSession.sparkContext.broadcast(items)
    names = frame.columns
    plain = ["n_words", "longest", "spans", "spans_bytes", "items"]
    keep = [c for c in names if c not in plain]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        auto = Automaton(block, window) if block else None
        pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for a, b, data, offsets in tb.slices(text_of(batch)):
                starts, ends, bounds = tb.words(data, offsets)
                n_rows = b - a
                spans: list[list] = [[] for _ in range(n_rows)]
                seen_items: list[set] = [set() for _ in range(n_rows)]
                longest = [0] * n_rows
                if "longest" in names:
                    longest = batch.column("longest").slice(a, n_rows).to_pylist()
                    spans = [[(s["start"], s["end"]) for s in x] for x in batch.column("spans").slice(a, n_rows).to_pylist()]
                    seen_items = [set(x) for x in batch.column("items").slice(a, n_rows).to_pylist()]
                if auto:
                    hashed = tb.hashes(data, starts, ends)
                    at = np.minimum(np.searchsorted(auto.vocab, hashed), len(auto.vocab) - 1)
                    known = auto.vocab[at] == hashed
                    # A word outside the vocabulary resets the automaton, so runs of known words stand alone.
                    r0, r1 = tb.runs(known, bounds)
                    long = (r1 - r0) >= auto.shortest
                    row = np.searchsorted(bounds, r0, side="right") - 1
                    for s, e, i in zip(r0[long].tolist(), r1[long].tolist(), row[long].tolist()):
                        found, seen, most = auto.stream(at[s:e].tolist())
                        longest[i] = max(longest[i], most)
                        if found:
                            base = s - int(bounds[i])
                            spans[i] += [(x + base, y + base) for x, y in found]
                            seen_items[i] |= {block[j][0] for j in seen}
                spans = [_merged(x) if x else [] for x in spans]
                text_start = offsets[:-1]
                as_bytes = [[(int(starts[bounds[i] + x] - text_start[i]), int(ends[bounds[i] + y - 1] - text_start[i])) for x, y in s] for i, s in enumerate(spans)]
                lists = [pa.array([[{"start": x, "end": y} for x, y in s] for s in each], pairs) for each in (spans, as_bytes)]
                listed = pa.array([sorted(x for x in s if x is not None) for s in seen_items], pa.list_(pa.string()))
                own = [batch.column(c).slice(a, n_rows) for c in keep]
                yield pa.record_batch([*own, pa.array(np.diff(bounds).astype(np.int64)), pa.array(longest, pa.int64()), *lists, listed], names=[*keep, *plain])

    kinds = ", ".join(f"`{c}` {frame.schema[c].dataType.simpleString()}" for c in keep)
    return frame.mapInArrow(run, f"{kinds}, n_words bigint, longest bigint, spans {SPANS}, spans_bytes {SPANS}, items array<string>")


def match(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int | None = None,
) -> DataFrame:
    """One row per document: id, n_words, n_hit, longest, spans, items, spans_bytes.

    ``spans`` are merged hit word ranges [start, end), ``spans_bytes`` the same as
    byte ranges of the UTF-8 text, ``longest`` the longest matched length in words.
    """
    item = F.col(item_col).cast("string")
    words = benchmark.agg(F.coalesce(F.sum(F.regexp_count(F.coalesce(item_text_col, F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))), F.lit(0))).first()[0]
    blocks = max(1, -(-words // (block_words or BLOCK_WORDS)))
    frame, text_of = tb.text_input(docs, id_col, text_col)
    tables = Tables(docs.sparkSession, "decontaminate") if blocks > 1 else None
    for k in range(blocks):
        part = benchmark if blocks == 1 else benchmark.filter(F.pmod(F.xxhash64(item, item_text_col), F.lit(blocks)) == k)
        rows = [tuple(r) for r in part.select(item, item_text_col).distinct().collect()]
        frame = _pass(frame, text_of, _items(sorted(rows, key=str)), window)
        if k + 1 < blocks:
            frame = tables.keep(frame, f"pass-{k}")
            tables.drop(f"pass-{k - 1}")
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["end"] - s["start"])
    out = frame.select(F.col("_id"), "n_words", hit.alias("n_hit"), "longest", "spans", "spans_bytes", "items", F.size("items").cast("bigint").alias("n_items"))
    return out.withColumnRenamed("_id", id_col)


def contaminated():
    """The contract's rule: some word hit, and at least one word in twenty."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def without_spans(text, spans):
    """The text without the given byte spans, which lie in order and apart, as a column."""
    raw = F.encode(text, "UTF-8")
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.octet_length(text).cast("bigint")))
    pieces = F.zip_with(begins, ends, lambda a, b: F.decode(F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")), "UTF-8"))
    return F.array_join(pieces, "")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", max_span: int | None = None, **options) -> DataFrame:
    """Documents that stay under the coverage limit, in the columns of ``docs``.

    With ``max_span`` set, hit spans longer than that many words are cut out of the
    documents that stay; by default they keep their text unchanged.  Whole rows
    travel with their result, so repeated ids stay apart and nothing is joined.
    """
    kept = match(tb.as_rows(docs), benchmark, id_col="row", text_col=f"row.{text_col}", **options).filter(~contaminated())
    if max_span is not None:
        long = F.expr(f"transform(filter(arrays_zip(spans, spans_bytes), s -> s.spans.end - s.spans.start > {int(max_span)}), s -> s.spans_bytes)")
        text = F.col(f"row.{text_col}")
        kept = kept.withColumn("_cut", long)
        kept = kept.withColumn("row", F.when(F.size("_cut") > 0, F.col("row").withField(text_col, without_spans(text, F.col("_cut")))).otherwise(F.col("row")))
    return kept.select("row.*")


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = match(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


_EMPTY = hashlib.sha256(b"").hexdigest()

OP2_SQL = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(ws), {WINDOW}) AS n, list_aggregate(ws[i:i + least(len(ws), {WINDOW}) - 1], 'string_agg', ' ') AS g
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - {WINDOW} + 1, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, list_aggregate(ws[i:i + n - 1], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n)),
hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(len(w.ws), 0) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(its.n_items, 0) AS BIGINT) AS n_items, coalesce(sha256(its.items), '{_EMPTY}') AS items_sha256,
  coalesce(pos.n_hit, 0) > 0 AND 20 * coalesce(pos.n_hit, 0) >= coalesce(len(w.ws), 0) AS contaminated
FROM w LEFT JOIN pos ON w.doc_id = pos.doc_id LEFT JOIN its ON w.doc_id = its.doc_id
"""
