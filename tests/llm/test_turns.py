"""Prefix trie and structure repair of conversations against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltworks.llm import prefixtrie, turnrepair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_trie(convs):
    """Rows of the trie of {conv_id: [(digest, bytes)]}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for p, ms in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(ms) - 1) * (p[-1][1] if p else 0)
            leaves[p[:d]] += not kids[p]
    ends = lambda p: sha(",".join(map(str, sorted(c for c in members[p] if len(convs[c]) == len(p)))))
    return sorted(((min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), kids[p], leaves[p], saved[p], ends(p)) for p, ms in members.items()), key=str)


def digest(name):
    return hashlib.sha256(str(name).encode()).digest()[: prefixtrie.WIDTH]


def run_blocks(convs, cuts):
    """The operator's steps without Spark: blocks between ``cuts``, joined ``FAN`` at a time."""
    rows = sorted((b"".join(digest(t[0]) for t in turns), c, [t[1] for t in turns]) for c, turns in convs.items())
    nodes, pieces, opened = [], defaultdict(list), []
    for k, (a, b) in enumerate(itertools.pairwise([0, *cuts, len(rows)])):
        if a == b:
            continue
        batch = pa.table({"block": [k] * (b - a), "key": pa.array([r[0] for r in rows[a:b]], pa.binary()), "bytes": pa.array([r[2] for r in rows[a:b]], pa.list_(pa.int64())), "conv": [r[1] for r in rows[a:b]]})
        for out in prefixtrie.scan(iter(batch.to_batches(max_chunksize=3))):
            for r in out.to_pylist():
                {"node": nodes.append, "open": opened.append}.get(r["kind"], lambda r: pieces[r["own"]].append(((r["block"], r["piece"]), r["ends"])))(r)
    n = max(r["block"] for r in opened)
    while True:
        whole, groups = n < prefixtrie.FAN, defaultdict(list)
        for r in opened:
            groups[r["block"] // prefixtrie.FAN].append(r)
        n //= prefixtrie.FAN
        done = [r for g in groups.values() for r in prefixtrie.joiner(whole)(pa.table({"block": [r["block"] for r in g], "blob": [r["blob"] for r in g]})).to_pylist()]
        nodes += [r for r in done if r["kind"] == "node"]
        if whole:
            break
        opened = [r for r in done if r["kind"] == "open"]
    of = {r["own"]: r["conv_id"] for r in nodes}
    assert len(of) == len(nodes)
    out = []
    for r in nodes:
        for d in range(r["lo"], r["hi"] + 1):
            last = d == r["hi"]
            ends = r["ends"] if last else None
            ends = sha(",".join(t for _, t in sorted(pieces[r["own"]]))) if ends == "*" else ends
            parent = r["conv_id"] if d > r["lo"] else of[r["parent"]] if d else None
            out.append((r["conv_id"], d, parent, r["n"], r["kids"] if last else 1, r["leaves"], r["shared"] - (r["n"] - 1) * r["before"][d - r["lo"]] if r["n"] > 1 else 0, ends or prefixtrie.NO_ENDS))
    return sorted(out, key=str)


def test_blocks_of_any_size_give_the_trie(monkeypatch):
    rng = random.Random(3)
    for trial in range(400):
        monkeypatch.setattr(prefixtrie, "PIECE", rng.choice([4, 1 << 20]))
        n, kinds = rng.randint(1, 25), rng.randint(1, 3)
        convs = {c: [(t, len(str(t)) + t) for t in (rng.randrange(kinds) for _ in range(rng.randint(0, 5)))] for c in rng.sample(range(100), n)}
        cuts = sorted(rng.randint(0, n) for _ in range(rng.randint(0, 8)))
        monkeypatch.setattr(prefixtrie, "FAN", rng.choice([2, 3, 64]))
        assert run_blocks(convs, cuts) == brute_trie(convs), (trial, convs, cuts)


def test_common_prefix_of_digests():
    a = b"".join(map(digest, range(50)))
    for n in range(50):
        b = a[: 16 * n] + digest("other") + a[16 * (n + 1) :]
        assert prefixtrie.common(a, b) == n
        assert prefixtrie.common(a, a[: 16 * n]) == n


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), sha(f"{len(role.encode())}:{role}{text}"), (role, text)))
    own = {c: [((r, t), len(t.encode())) for _, _, (r, t) in sorted(x)] for c, x in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def conversations(n, seed):
    """Few kinds of turns; nulls, ties, repeated rows and a long conversation."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([None, t, t, t, t, t // 2]), rng.choice(["user", "assistant", "system", None, "tool", "", "über"]), rng.choice(["Hello.", "What is it?", "and then", "", " \t", None, "né!", "a\nb."])))
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for c in (500, 501, 502, 503) for t in range(40)]
    return rows + rows[:3] + [(None, 1, "user", "No id."), (None, None, None, None)]


def trie_rows(df):
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def test_trie_of_a_table_over_many_blocks(spark):
    rows = conversations(120, 5)
    table = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("clash")).withColumn("block", F.lit(1)).withColumn("turns", F.lit("x"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert trie_rows(prefixtrie.prefix_trie(prefixtrie.rebuilt(prefixtrie.sequences(table)))) == brute_trie(rebuilt_by_hand(rows))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_trie_of_an_empty_table_and_of_turnless_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefixtrie.prefix_trie(prefixtrie.rebuilt(prefixtrie.sequences(empty))).count() == 0
    one = spark.createDataFrame([(1, 0, "user", "x")], SCHEMA)  # crc32("1") % 9 turns come from the absent conversation 0
    assert zlib.crc32(b"1") % 9 > 0
    assert trie_rows(prefixtrie.prefix_trie(prefixtrie.rebuilt(prefixtrie.sequences(one)))) == [(1, 0, None, 1, 0, 1, 0, sha("1"))]


@pytest.mark.parametrize("query, sql", [(prefixtrie.op11_prefix_trie, prefixtrie.OP11_SQL), (turnrepair.op12_turn_repair, turnrepair.OP12_SQL)])
def test_queries_agree_with_sql(spark, query, sql):
    import duckdb

    path = "/root/testdata/sf0.001"
    got = query(spark, path)
    c = duckdb.connect()
    c.execute(f"create view conversations as select * from '{path}/conversations.parquet'")
    found = c.execute(sql)
    assert [x[0] for x in found.description] == got.columns
    assert sorted(found.fetchall(), key=str) == sorted(map(tuple, got.collect()), key=str)


# -- repair


def hurt_by_hand(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        out[c]
        name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        role, text, a = " " if role is None else role, " " if text is None else text, zlib.crc32(name.encode()) % 20
        if a:
            text = "" if a == 1 else re.sub("[.!?]", "", text) if a == 2 else text
            out[c] += [(turn, "user" if a == 4 else role, text)] * (2 if a == 3 else 1)
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, sha(f"{len(r[1].encode())}:{r[1]}{r[2]}")[:32])) for c, x in out.items()}


SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def faults_of(rows):
    out = []
    for i, (_, role, text) in enumerate(rows):
        body = text.rstrip(SPACES)
        out.append("b" if not body else "d" if (role, text) in [r[1:] for r in rows[:i]] else "t" if body[-1] not in ".!?" else "k")
    return out


def brute_repair(rows, deepest=2):
    """Every edit script with at most ``deepest`` inserts at a place; least (cost, audit, lines)."""
    faults = faults_of(rows)
    found = []
    inserts = [[r + ":" for r in roles] for n in range(deepest + 1) for roles in itertools.product(["user", "assistant"], repeat=n)]
    legal = re.compile(r"(s?(ua)+)?")

    def walk(i, cost, audit, lines):
        for extra in inserts:
            now = (cost + 2 * len(extra), audit + "I" * len(extra), lines + extra)
            if i == len(rows):
                if legal.fullmatch("".join(x[:1] for x in now[2])):
                    found.append(now)
                continue
            role, text, fault = rows[i][1], rows[i][2], faults[i]
            walk(i + 1, now[0] + 3, now[1] + "D", now[2])
            if fault in "kt":
                more = int(fault == "t")
                walk(i + 1, now[0] + more, now[1] + "K", now[2] + [f"{role}:{text}"])
                for r in ("user", "assistant"):
                    walk(i + 1, now[0] + 2 + more, now[1] + "R", now[2] + [f"{r}:{text}"])

    walk(0, 0, "", [])
    return min(found)


def counts_of(rows):
    faults, turns = faults_of(rows), [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal


def test_recursion_agrees_with_every_edit_script():
    rng = random.Random(11)
    for _ in range(120):
        rows = [(t, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["Yes.", "No", " ", "Why?"])) for t in range(rng.randint(0, 3))]
        cost, audit, lines = brute_repair(rows)
        fold, at = turnrepair.Fold(), 0
        cuts = sorted(rng.sample(range(1, len(rows)), rng.randint(0, len(rows) - 1))) if len(rows) > 1 else []
        states = "".join(r[1][:1] if r[1][:1] in ("s", "u", "a") and r[1] else "x" for r in rows)
        faults = "".join(faults_of(rows))
        parts = [(k, states[a:b], faults[a:b]) for k, (a, b) in enumerate(itertools.pairwise([0, *cuts, len(rows)])) if b > a]
        if not parts:
            assert (cost, audit) == (0, "")
            continue
        batch = pa.record_batch([pa.array([0] * len(parts)), pa.array([p[0] for p in parts]), pa.array([p[1] for p in parts]), pa.array([p[2] for p in parts])], names=["conv_id", "part", "inits", "faults"])
        for out in turnrepair.walked(iter([batch])):
            for r in out.to_pylist():
                fold.add(r["part"], r["inits"], r["faults"], None, None, 0, r["costs"], r["audits"])
        *pieces, total = fold.result(7)
        assert (total[9], total[10]) == (cost, audit)
        repaired = []
        for piece in sorted(pieces, key=lambda p: p[1]):
            size = len(parts[piece[1]][1])
            own = [("", ""), *(r[1:] for r in rows[at : at + size])]
            repaired += [f"{role or own[i][0]}:{own[i][1]}" for i, role in zip(piece[2], piece[3])]
            at += size
        assert repaired == lines


@pytest.mark.parametrize("bits", [1, 8])
def test_repair_of_a_table_in_parts(spark, monkeypatch, tmp_path, bits):
    rows = [r for r in conversations(40, 9) if r[0] is None or r[0] < 40] + [(77, t, "user", "Same.") for t in range(30)]
    spark.createDataFrame(rows, SCHEMA).withColumn("part", F.lit("clash")).withColumn("pos", F.lit(0)).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    monkeypatch.setattr(turnrepair, "PART", bits)
    got = {r.conv_id: r for r in turnrepair.op12_turn_repair(spark, str(tmp_path)).collect()}
    hurt = hurt_by_hand(rows)
    assert set(got) == set(hurt)
    checked = 0
    for c, own in hurt.items():
        r = got[c]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal) == counts_of(own), (c, own)
        if len(own) <= 4:
            cost, audit, lines = brute_repair(own)
            assert (r.cost, r.audit, r.repaired_sha256) == (cost, audit, sha("\n".join(lines))), (c, own)
            checked += 1
    assert checked >= 10


def test_repair_of_an_empty_table_and_of_a_table_dropped_whole(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "a/conversations.parquet"))
    assert turnrepair.op12_turn_repair(spark, str(tmp_path / "a")).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "x")], SCHEMA).write.parquet(str(tmp_path / "b/conversations.parquet"))
    assert [tuple(r) for r in turnrepair.op12_turn_repair(spark, str(tmp_path / "b")).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", sha(""))]
