"""Conversation structure repair: the cheapest edits that make the roles alternate.

A conversation's role initials have to be ``(s?(ua)+)?``.  Each of its rows is kept (0),
given the role that the grammar wants next (2) or deleted (3, the only choice for blank
and duplicate rows); user and assistant rows without text may be inserted anywhere (2);
a truncated row that stays costs 1 more.  Of the cheapest edits those whose initials
(D, I, K, R) are least in ASCII order are taken, as the conversation's audit.

The grammar is a deterministic automaton of four states: nothing yet, after s, after u,
after a.  A DuckDB recursive query goes through hash-partitioned batches inside Spark
tasks: each recursion advances all conversations by one turn and keeps the least (cost,
audit) of each state, inserts included.  Equal costs never come with audits of which one
begins the other (letters and inserts fix the cost), so keeping the least is enough.

Conversations are dealt in parts of at most ``PART`` rows, since one may hold a large
share of all rows: rows are placed by a sort over the whole table, a part's recursion
starts from each state, and a pass over the parts in order, which hold a few numbers and
letters a row, joins them.  Texts take no part in that; they meet their part's letters
afterwards.  The hash of a conversation in several parts is made from a stream.

Defined results: a null role or text is one space, and so is a null conv_id or turn where
it is printed; rows without a conv_id are one conversation; turns are ordered nulls
first, rows of one turn by the digest of role and text; a conversation of which no row is
left has zeros, an empty audit and the hash of nothing; further columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.prefixtrie import SQL_CRC
from siltworks.llm.workspace import Tables

#: Bits of the rows of a part: at most 256.
PART = 8
#: Rows whose recursion runs in one DuckDB query.
BATCH_ROWS = 16_384
#: White space, ends of sentences, edits and their costs.
SPACE, STOPS = " \t\n\x0b\x0c\r", ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
EMPTY = hashlib.sha256(b"").hexdigest()


class Repair(NamedTuple):
    #: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, n_parts.
    decisions: DataFrame
    #: conv_id, part, n_parts, turns (array of role and text): the repaired conversations in parts, in order.
    turns: DataFrame


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of ``conv_id:turn`` names."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("_a")).filter("_a != 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_a") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_a") == 1, "").when(F.col("_a") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("_a") == 3, 2).otherwise(1))).alias("_"),
    ).drop("_")


MACROS = f"""
CREATE MACRO edit(p, price, letter) AS CASE WHEN p IS NULL THEN NULL ELSE {{'c': p.c + price, 'a': p.a || letter}} END;
CREATE MACRO insert_one(p) AS edit(p, {INSERT}, 'I');
"""

#: seg (k, n, inits, faults) to the best (cost, audit) from each state s to each state.
RECURSION = f"""
WITH RECURSIVE walk(k, s, t, p0, ps, pu, pa) USING KEY (k, s) AS (
  SELECT k, s, 0, n0, ns, u, least(na, insert_one(u))
  FROM (SELECT *, least(nu, insert_one(n0), insert_one(ns), insert_one(na)) AS u FROM (
    SELECT k, s, CASE WHEN s = 0 THEN origin END AS n0, CASE WHEN s = 1 THEN origin END AS ns, CASE WHEN s = 2 THEN origin END AS nu, CASE WHEN s = 3 THEN origin END AS na
    FROM seg, range(4) AS r(s), (SELECT {{'c': 0::BIGINT, 'a': ''}} AS origin)))
  UNION
  SELECT k, s, t + 1, n0, ns, u, least(na, insert_one(u))
  FROM (SELECT *, least(nu, insert_one(n0), insert_one(ns), insert_one(na)) AS u FROM (
    SELECT k, s, t, edit(p0, {DELETE}, 'D') AS n0,
      least(edit(ps, {DELETE}, 'D'), CASE WHEN may AND role = 's' THEN edit(p0, {KEEP} + more, 'K') END) AS ns,
      least(edit(pu, {DELETE}, 'D'), CASE WHEN may AND role = 'u' THEN edit(least(p0, ps, pa), {KEEP} + more, 'K') END, CASE WHEN may THEN edit(least(p0, ps, pa), {REROLE} + more, 'R') END) AS nu,
      least(edit(pa, {DELETE}, 'D'), CASE WHEN may AND role = 'a' THEN edit(pu, {KEEP} + more, 'K') END, CASE WHEN may THEN edit(pu, {REROLE} + more, 'R') END) AS na
    FROM (SELECT w.*, substr(g.inits, w.t + 1, 1) AS role, substr(g.faults, w.t + 1, 1) NOT IN ('b', 'd') AS may,
        CASE WHEN substr(g.faults, w.t + 1, 1) = 't' THEN {TRUNCATED} ELSE 0 END AS more
      FROM walk w JOIN seg g ON g.k = w.k AND w.t < g.n)))
)
SELECT k, [p0.c, ps.c, pu.c, pa.c] AS costs, [p0.a, ps.a, pu.a, pa.a] AS audits FROM walk ORDER BY k, s
"""

WALKED = "conv_id {id}, part bigint, inits string, faults string, first bigint, last bigint, n_turns bigint, costs array<array<bigint>>, audits array<array<string>>"


def walked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The recursion over batches of parts; four rows of its result belong to each part."""
    import duckdb

    with duckdb.connect(config={"threads": 1}) as db:
        db.execute(MACROS)
        for batch in rows:
            sizes, a = [len(x) for x in batch.column("inits").to_pylist()], 0
            while a < len(sizes):
                b, total = a + 1, sizes[a]
                while b < len(sizes) and total + sizes[b] <= BATCH_ROWS:
                    total, b = total + sizes[b], b + 1
                own = batch.slice(a, b - a)
                seg = pa.table({"k": pa.array(range(b - a), pa.int32()), "n": pa.array(sizes[a:b], pa.int32()), "inits": own.column("inits"), "faults": own.column("faults")})
                db.register("seg", seg)
                costs, audits = [], []
                for _, c, t in db.execute(RECURSION).fetchall():
                    costs.append(c)
                    audits.append(t)
                db.unregister("seg")
                quads = range(0, len(costs), 4)
                found = [pa.array([costs[i : i + 4] for i in quads], pa.list_(pa.list_(pa.int64()))), pa.array([audits[i : i + 4] for i in quads], pa.list_(pa.list_(pa.string())))]
                yield pa.RecordBatch.from_arrays([*own.columns, *found], names=[*own.schema.names, "costs", "audits"])
                a = b


FOLDED = "conv_id {id}, part bigint, rows array<int>, roles array<string>, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, n_parts bigint"
ARROW = {"string": pa.string(), "int": pa.int32(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
LEGAL = {"su", "ua", "au"}


#: The role that the grammar wants next, and the state after a role.
WANTED = {NOTHING: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def planned(state: int, piece: str, inits: str) -> tuple[list[int], list[str | None]]:
    """The turns that a part's letters leave: each one's row (from 1; 0: inserted) and its new role."""
    rows, roles, at = [], [], 0
    for letter in piece:
        at += letter != "I"
        if letter != "D":
            role = None if letter == "K" else WANTED[state]
            rows.append(0 if letter == "I" else at)
            roles.append(role)
            state = AFTER[(role or inits[at - 1])[0]]
    return rows, roles


class Fold:
    """One conversation's parts, in order: counts, and the best way into each state."""

    def __init__(self):
        self.parts: list[tuple[int, str]] = []
        self.faults = {"b": 0, "d": 0, "t": 0}
        self.illegal = self.n_turns = 0
        self.first = self.last = None
        self.role = ""
        #: For each state: cost, audit, and the chain of (state before, piece) that led there.
        self.ways: list[tuple | None] = [(0, "", None), None, None, None]

    def add(self, part: int, inits: str, faults: str, first: int | None, last: int | None, n_turns: int, costs: list, audits: list) -> None:
        self.parts.append((part, inits))
        for k in self.faults:
            self.faults[k] += faults.count(k)
        chain = self.role + inits
        self.illegal += sum(chain[i : i + 2] not in LEGAL for i in range(len(chain) - 1))
        self.role = chain[-1]
        if first is not None:
            self.n_turns += n_turns - (first == self.last)
            self.first = first if self.first is None else self.first
            self.last = last
        ways: list[tuple | None] = [None] * 4
        for s, way in enumerate(self.ways):
            for e in range(4):
                if way and costs[s][e] is not None:
                    cost, text = way[0] + costs[s][e], way[1] + audits[s][e]
                    if ways[e] is None or (cost, text) < ways[e][:2]:
                        ways[e] = (cost, text, (way[2], s, audits[s][e]))
        self.ways = ways

    def result(self, conv) -> Iterator[tuple]:
        cost, audit, chain = min((w for w in (self.ways[NOTHING], self.ways[ASSISTANT]) if w), key=lambda w: w[:2])
        n = len(self.parts)
        gaps = self.last - self.first + 1 - self.n_turns if self.first is not None else 0
        for part, inits in reversed(self.parts):
            chain, state, piece = chain
            yield conv, part, *planned(state, piece, inits), *[None] * 7, n
        yield conv, None, None, None, gaps, self.faults["b"], self.faults["d"], self.faults["t"], self.illegal, cost, audit, n


def folded(schema: pa.Schema):
    def fold(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts of a task's conversations in order; one conversation is held at a time."""
        conv, one, out = None, None, []
        for batch in rows:
            for c, *part in zip(*(x.to_pylist() for x in batch.columns)):
                if one is None or c != conv:
                    if one:
                        out.extend(one.result(conv))
                    conv, one = c, Fold()
                one.add(*part)
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
                    out = []
        if one:
            out.extend(one.result(conv))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    return fold


def repair(turns: DataFrame) -> Repair:
    """Decisions and repaired turns of the conversations of (conv_id, turn, role, text)."""
    spark = turns.sparkSession
    tables = Tables(spark, "turnrepair")
    digest = F.substring(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 32)
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    ordered = rows.withColumn("digest", digest).repartitionByRange("conv_id", "turn", "digest").sortWithinPartitions("conv_id", "turn", "digest")
    body = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    placed = tables.keep(
        ordered.withColumn("pos", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("pos", PART))
        .withColumn("initial", F.when(initial.isin("s", "u", "a"), initial).otherwise("x"))
        .withColumn("fault", F.when(body == "", "b").when(~F.right(body, F.lit(1)).isin(*STOPS), "t").otherwise("k")),
        "placed",
    )
    # Few rows repeat: their first positions are found before anything is joined.
    again = placed.filter("fault != 'b'").groupBy("conv_id", "digest").agg(F.min("pos").alias("first_pos"), F.count("*").alias("n")).filter("n > 1").select(F.col("conv_id").alias("_c"), F.col("digest").alias("_d"), "first_pos")
    codes = (
        placed.select("conv_id", "part", "pos", "turn", "digest", "initial", "fault")
        .join(again, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("digest") == F.col("_d")), "left")
        .select("conv_id", "part", F.struct("pos", "turn", "initial", F.when(F.col("pos") > F.col("first_pos"), "d").otherwise(F.col("fault")).alias("fault")).alias("r"))
    )
    parts = (
        codes.groupBy("conv_id", "part")
        .agg(F.sort_array(F.collect_list("r")).alias("r"))
        .select(
            "conv_id",
            "part",
            F.array_join("r.initial", "").alias("inits"),
            F.array_join("r.fault", "").alias("faults"),
            F.array_min("r.turn").alias("first"),
            F.array_max("r.turn").alias("last"),
            F.size(F.array_distinct(F.array_compact("r.turn"))).cast("bigint").alias("n_turns"),
        )
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    ways = parts.mapInArrow(walked, WALKED.format(id=kind)).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    arrow = pa.schema([(f, ARROW.get(t, pa.int64())) for f, t in (x.split() for x in FOLDED.format(id=kind).split(", "))])
    fold = tables.keep(ways.mapInArrow(folded(arrow), FOLDED.format(id=kind)), "folded")
    decisions = fold.filter("part IS NULL").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "n_parts")
    # A key that is never null, so that texts are shuffled once, by it, for grouping and join.
    named = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("name")
    plans = fold.filter("part IS NOT NULL").select("conv_id", named, "part", "rows", "roles", "n_parts")
    own = placed.select(named, "part", F.struct("pos", "role", "text").alias("own")).groupBy("name", "part").agg(F.sort_array(F.collect_list("own")).alias("own"))
    turn = F.transform(
        F.arrays_zip("rows", "roles"),
        lambda p: F.struct(F.coalesce(p["roles"], F.get("own", p["rows"] - 1)["role"]).alias("role"), F.when(p["rows"] == 0, "").otherwise(F.get("own", p["rows"] - 1)["text"]).alias("text")),
    )
    out = own.join(plans, ["name", "part"]).select("conv_id", "part", "n_parts", turn.alias("turns"))
    repaired = tables.keep(out, "repaired")
    tables.drop("placed")
    return Repair(decisions, repaired)


def streamed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each conversation's lines, whose parts come in order; holds one batch."""
    conv, digest = None, None

    def done() -> pa.RecordBatch:
        return pa.record_batch([pa.array([conv], kind), pa.array([digest.hexdigest()])], names=["conv_id", "hash"])

    for batch in rows:
        kind = batch.column(0).type
        for c, lines in zip(*(batch.column(i).to_pylist() for i in (0, 2))):
            if digest is None or c != conv:
                if digest:
                    yield done()
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(lines.encode())
    if digest:
        yield done()


def hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, hash) of the lines ``role:text`` of each repaired conversation that has any."""
    lines = turns.filter(F.size("turns") > 0).select("conv_id", "part", "n_parts", F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n").alias("lines"))
    # Most conversations are one part and are hashed where they lie.
    one = lines.filter("n_parts = 1").select("conv_id", F.sha2(F.col("lines"), 256).alias("hash"))
    more = lines.filter("n_parts > 1").select("conv_id", "part", "lines").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return one.unionAll(more.mapInArrow(streamed, one.schema.simpleString()[7:-1].replace(":", " ")))


def op12_turn_repair(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = repair(damaged(turns))
    every = turns.select(F.col("conv_id").alias("_id")).distinct()
    decided = every.join(found.decisions, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    rows = decided.join(hashes(found.turns), F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select(F.col("_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("hash", F.lit(EMPTY)).alias("repaired_sha256"))


_NAME = "concat(coalesce(conv_id::varchar, ' '), ':', coalesce(turn::varchar, ' '))"
OP12_SQL = f"""
WITH RECURSIVE marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {SQL_CRC.format(s="name")} % 20 AS a
  FROM (SELECT *, {_NAME} AS name FROM conversations)),
hurt AS (
  SELECT conv_id, turn, CASE WHEN a = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN a = 1 THEN '' WHEN a = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM marked, unnest(range(CASE WHEN a = 3 THEN 2 ELSE 1 END)) AS u(copy) WHERE a <> 0),
line AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(strlen(role), ':', role, text))) AS i FROM hurt),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM line),
judged AS (
  SELECT *, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
      WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM seen),
base AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND concat(before, r) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id),
ins(frm, goes) AS (VALUES ('0', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
walk AS (
  SELECT conv_id, 0 AS i, {{'0': {{'c': 0, 'a': '', 'x': []::VARCHAR[]}}, 's': NULL::STRUCT(c INTEGER, a VARCHAR, x VARCHAR[]), 'u': {{'c': 2, 'a': 'I', 'x': ['user:']}}, 'a': {{'c': 4, 'a': 'II', 'x': ['user:', 'assistant:']}}}} AS w FROM base
  UNION ALL
  SELECT conv_id, i, {{'0': n0, 's': ns, 'u': nu, 'a': least(na, CASE WHEN nu IS NOT NULL THEN {{'c': nu.c + 2, 'a': nu.a || 'I', 'x': list_append(nu.x, 'assistant:')}} END)}}
  FROM (
    SELECT conv_id, i, n0, ns, na, least(nu, {{'c': n0.c + 2, 'a': n0.a || 'I', 'x': list_append(n0.x, 'user:')}},
      CASE WHEN ns IS NOT NULL THEN {{'c': ns.c + 2, 'a': ns.a || 'I', 'x': list_append(ns.x, 'user:')}} END,
      CASE WHEN na IS NOT NULL THEN {{'c': na.c + 2, 'a': na.a || 'I', 'x': list_append(na.x, 'user:')}} END) AS nu
    FROM (
      SELECT j.conv_id, j.i, {{'c': w.w['0'].c + 3, 'a': w.w['0'].a || 'D', 'x': w.w['0'].x}} AS n0,
        least(CASE WHEN w.w.s IS NOT NULL THEN {{'c': w.w.s.c + 3, 'a': w.w.s.a || 'D', 'x': w.w.s.x}} END,
          CASE WHEN stays AND j.r = 's' THEN {{'c': w.w['0'].c + more, 'a': w.w['0'].a || 'K', 'x': list_append(w.w['0'].x, own)}} END) AS ns,
        least(CASE WHEN w.w.u IS NOT NULL THEN {{'c': w.w.u.c + 3, 'a': w.w.u.a || 'D', 'x': w.w.u.x}} END,
          CASE WHEN stays THEN {{'c': to_u.c + more + CASE WHEN j.r = 'u' THEN 0 ELSE 2 END, 'a': to_u.a || CASE WHEN j.r = 'u' THEN 'K' ELSE 'R' END, 'x': list_append(to_u.x, CASE WHEN j.r = 'u' THEN own ELSE 'user:' || j.text END)}} END) AS nu,
        least(CASE WHEN w.w.a IS NOT NULL THEN {{'c': w.w.a.c + 3, 'a': w.w.a.a || 'D', 'x': w.w.a.x}} END,
          CASE WHEN stays AND w.w.u IS NOT NULL THEN {{'c': w.w.u.c + more + CASE WHEN j.r = 'a' THEN 0 ELSE 2 END, 'a': w.w.u.a || CASE WHEN j.r = 'a' THEN 'K' ELSE 'R' END, 'x': list_append(w.w.u.x, CASE WHEN j.r = 'a' THEN own ELSE 'assistant:' || j.text END)}} END) AS na
      FROM (SELECT *, least(w['0'], w.s, w.a) AS to_u FROM walk) w
      JOIN (SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS more, concat(role, ':', text) AS own FROM judged) j
        ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1))),
best AS (SELECT b.*, least(w.w['0'], w.w.a) AS z FROM base b JOIN walk w ON w.conv_id IS NOT DISTINCT FROM b.conv_id AND w.i = b.n)
SELECT o.conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(z.c, 0)::bigint AS cost, coalesce(z.a, '') AS audit, sha256(coalesce(array_to_string(z.x, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""
