"""Candidates from scored records: near-title groups behind leaders, fixed clusters, roll-up.

Greedy grouping in the order (score desc, title, ord) lets a title join the first
leader of its publisher whose similarity reaches the threshold, or lead itself.  Who
leads is the lexicographically first independent set of the similarity graph: a title
that no earlier similar title precedes leads, titles next to a leader do not, and the
rest is settled in a few rounds.  So no publisher is gathered anywhere.

Pairs come from a prefix filter on the rarest tokens and one on the rarest runs of two,
three or four characters, the longer the title the longer the run.  The first holds every
pair that reaches the threshold by tokens, the second every pair that reaches it by
characters, such as titles without spaces that differ in one of them.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.functions.ids import candidate_id
from siltworks.functions.text import STOP_WORDS, normalize_title
from siltworks.functions.times import iso
from siltworks.operators.checkpoints import with_checkpoints

THRESHOLD = 0.9


def title_similarity(a: str, b: str, least: float = 0.0) -> float:
    """max(token Jaccard, sequence ratio) of two normalised titles.

    With ``least``, the ratio is skipped where its cheap upper bounds stay below it.
    """
    ta, tb = ({w for w in t.split() if len(w) > 1 and w not in STOP_WORDS} for t in (a, b))
    overlap = len(ta & tb) / len(ta | tb) if ta | tb else 0.0
    if least and overlap >= least:
        return overlap
    matcher = SequenceMatcher(None, a, b)
    if least and (matcher.real_quick_ratio() < least or matcher.quick_ratio() < least):
        return overlap
    return max(overlap, matcher.ratio())


def _met(each: DataFrame, kept: Column, reach, sure: Column | None = None) -> DataFrame:
    """Pairs of a publisher's titles that share one of their rarest elements; a before b.

    ``each`` has a row (id, _key, publisher, place, size, w; norm for ``sure``) for each element w of a title;
    ``kept`` says of a row, by ``size`` and its place ``i`` among the title's elements from
    the rarest on, whether a pair that counts must share one of these; ``reach`` bounds
    what two rows that share an element may be, and ``sure`` (of p and q) is asked of the
    titles met before they are shuffled.  Titles that share many elements meet as often, so
    their pairs (a, _a, b, _b: ids and keys) carry no texts until ``_told`` adds them.
    """
    held = each.groupBy("publisher", "w").agg(F.count("*").alias("df")).filter("df > 1")
    same = (F.col("each.publisher").eqNullSafe(F.col("held.publisher"))) & (F.col("each.w") == F.col("held.w"))
    own = Window.partitionBy(*[c for c in ("id", "_key", "q") if c in each.columns])
    ranked = each.alias("each").join(held.alias("held"), same).select("each.*", "df")
    ranked = ranked.withColumn("i", F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("df", "w")) - 1)
    head = ranked.filter(kept)
    p, q = head.alias("p"), head.alias("q")
    pairs = p.join(q, (F.col("p.w") == F.col("q.w")) & F.col("p.publisher").eqNullSafe(F.col("q.publisher")) & (F.col("p.place") < F.col("q.place")) & reach)
    if sure is not None:
        pairs = pairs.filter(sure)
    return pairs.select(*[F.col(f"{side}.{c}").alias(name) for side, names in (("p", ("a", "_a")), ("q", ("b", "_b"))) for c, name in zip(("id", "_key"), names)]).distinct()


def _keyed(titles: DataFrame) -> DataFrame:
    """``titles`` with a key beside the id, so that an id that stands twice is two titles."""
    return titles.withColumn("_key", F.xxhash64("publisher", "norm"))


def _told(pairs: DataFrame, titles: DataFrame, value: str = "norm") -> DataFrame:
    """(a, b, x, y, place): pairs of ``_met`` with a value of both titles and the place of the first."""
    one = titles.select(F.col("id").alias("a"), F.col("_key").alias("_a"), F.col(value).alias("x"), "place")
    other = titles.select(F.col("id").alias("b"), F.col("_key").alias("_b"), F.col(value).alias("y"))
    return pairs.join(one, ["a", "_a"]).join(other, ["b", "_b"]).select("a", "b", "x", "y", "place")


def candidate_pairs(titles: DataFrame, floor: float) -> DataFrame:
    """Pairs (a, b, x, y, place) of one publisher that can reach a token Jaccard of ``floor``; none that does is left out.

    ``titles`` has id, publisher, norm and place, the order of a before b.
    """
    listed = _worded(titles)
    return _told(_word_pairs(listed, floor), listed)


def _worded(titles: DataFrame) -> DataFrame:
    words = F.filter(F.split("norm", " "), lambda w: (F.length(w) > 1) & ~w.isin(*STOP_WORDS))
    return _keyed(titles).withColumn("words", F.array_distinct(words)).withColumn("size", F.size("words"))


def _word_pairs(listed: DataFrame, floor: float) -> DataFrame:
    each = listed.select("id", "_key", "publisher", "place", "size", F.explode("words").alias("w"))
    left = F.least(F.col("p.size") - F.col("p.i"), F.col("q.size") - F.col("q.i"))
    return _met(each, F.col("i") <= F.col("size") - F.ceil(F.col("size") * floor - 1e-9), left >= floor / (1 + floor) * (F.col("p.size") + F.col("q.size")) - 1e-9)


#: Length of the runs of characters by which titles meet, from the shorter title's length on.
RUNS = ((40, 4), (16, 3), (0, 2))


def run_length(size: Column) -> Column:
    found = F.when(F.lit(False), 0)
    for least, q in RUNS:
        found = found.when(size >= least, q)
    return found


def least_shared(total, q, threshold: float):
    """Runs of ``q`` characters that titles of ``total`` characters together share at least.

    A ratio t matches t x total / 2 characters, in at most as many pieces as there are
    unmatched characters and one more; a piece has q - 1 runs less than characters.
    """
    return total * (threshold / 2) - (q - 1) * (total * (1 - threshold) + 1)


def _runs(texts: list[str], q: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the runs of q characters of each text, repeats told apart, sorted."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), size)
    m = max(len(points) - q + 1, 0)
    h = np.zeros(m, np.uint64)
    for k in range(q):
        h = (h + points[k : k + m] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    inside = owner[:m] == owner[len(points) - m :]
    h, owner = h[inside], owner[:m][inside]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(h)), 0))
    h = h + (np.arange(len(h)) - first).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    return h, np.searchsorted(owner, np.arange(len(texts) + 1))


def shared_runs(x: list[str], y: list[str], q: int) -> np.ndarray:
    """Runs of q characters that the texts of each row share, counted as often as they occur."""
    place = {t: i for i, t in enumerate(dict.fromkeys([*x, *y]))}
    h, bounds = _runs(list(place), q)
    pair, keys = [], []
    for side in (x, y):
        at = np.array([place[t] for t in side], np.int64)
        size = np.diff(bounds)[at]
        begin = np.repeat(bounds[at] - (np.cumsum(size) - size), size)
        pair.append(np.repeat(np.arange(len(at)), size))
        keys.append(h[begin + np.arange(len(begin))])
    pair, keys = np.concatenate(pair), np.concatenate(keys)
    # The row's number, spread over 64 bits, sets rows apart in one sort.
    keys = keys ^ (pair.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(keys)
    keys, pair = keys[order], pair[order]
    return np.bincount(pair[1:][keys[1:] == keys[:-1]], minlength=len(x))


def enough_shared(x: Column, y: Column, threshold: float) -> Column:
    """False where two texts share too few runs of characters for the ratio; many rows at once."""

    @F.pandas_udf("boolean")
    def test(xs: pd.Series, ys: pd.Series) -> pd.Series:
        a, b = xs.to_numpy(), ys.to_numpy()
        n, m = xs.str.len().to_numpy(), ys.str.len().to_numpy()
        lesser, out = np.minimum(n, m), np.zeros(len(a), bool)
        above = np.iinfo(np.int64).max
        for least, q in RUNS:
            for at in np.array_split(np.flatnonzero((lesser >= least) & (lesser < above)), -(-len(a) // 4096)):
                if len(at):
                    out[at] = shared_runs(list(a[at]), list(b[at]), q) >= least_shared(n[at] + m[at], q, threshold) - 1e-9
            above = least
        return pd.Series(out)

    return test(x, y)


def ratio_pairs(titles: DataFrame, threshold: float) -> DataFrame:
    """Pairs that can reach a sequence ratio of ``threshold`` (over 0.86); none that does is left out.

    The shorter title has at least t / (2 - t) of the longer's length and says how long the
    runs are by which the two meet, so a title stands under its own length's and, where
    that differs, under that of the shortest title it can meet.  Runs are counted as often
    as they occur.  A run that each title has once is matched, if at all, not further apart
    than the characters that the longer one has unmatched.
    """
    n, short = F.length("norm"), threshold / (2 - threshold)
    lengths = F.array_distinct(F.array(run_length(n), run_length(F.ceil(n * short - 1e-9))))
    titles = _keyed(titles)
    listed = titles.select("id", "_key", "publisher", "norm", "place", n.alias("n"), F.explode(lengths).alias("q")).filter(F.col("n") >= F.col("q"))
    grams = F.transform(F.sequence(F.lit(1), F.col("n") - F.col("q") + 1), lambda i: F.substr("norm", i, F.col("q")))
    spread = listed.withColumn("size", F.col("n") - F.col("q") + 1).select("id", "_key", "publisher", "norm", "place", "n", "q", "size", F.posexplode(grams).alias("at", "g"))
    own = Window.partitionBy("id", "_key", "q", "g")
    spread = spread.withColumn("nth", F.row_number().over(own.orderBy("at"))).withColumn("once", F.count("*").over(own) == 1)
    each = spread.withColumn("w", F.concat_ws("\u0001", "g", F.col("nth").cast("string"))).drop("g", "nth")
    least = F.greatest(F.lit(1), F.ceil(least_shared(F.col("n") * (1 + short), F.col("q"), threshold) - 1e-9))
    total = F.col("p.n") + F.col("q.n")
    lesser, longer = F.least("p.n", "q.n"), F.greatest("p.n", "q.n")
    left = F.least(F.col("p.size") - F.col("p.i"), F.col("q.size") - F.col("q.i"))
    reach = (F.col("p.q") == F.col("q.q")) & (F.col("p.q") == run_length(lesser)) & (2 * lesser >= threshold * total - 1e-9) & (left >= least_shared(total, F.col("p.q"), threshold) - 1e-9)
    beside = ~(F.col("p.once") & F.col("q.once")) | (F.abs(F.col("p.at") - F.col("q.at")) <= longer - threshold / 2 * total + 1e-9)
    return _told(_met(each, F.col("i") <= F.col("size") - least, reach & beside, enough_shared(F.col("p.norm"), F.col("q.norm"), threshold)), titles)


def jaccard_pairs(titles: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of all pairs of a publisher whose token Jaccard reaches the threshold."""
    listed = _worded(titles)
    both = F.size(F.array_intersect("x", "y"))
    # A generator's columns are worked out once: the filter does not compare the words again.
    met = _told(_word_pairs(listed, threshold), listed, "words").select("a", "b", F.size("x").alias("n"), F.size("y").alias("m"), F.inline(F.array(F.struct(both.alias("both")))))
    return met.select("a", "b", (F.col("both") / (F.col("n") + F.col("m") - F.col("both"))).alias("similarity")).filter(F.col("similarity") >= threshold)


def similar_titles(titles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (a, b, place) of similar titles of one publisher, a before b."""

    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        # The later title is the first argument, as the ratio depends on the order.
        return pd.Series([title_similarity(b, a, threshold) >= threshold for a, b in zip(x, y)])

    return candidate_pairs(titles, threshold).union(ratio_pairs(titles, threshold)).distinct().filter(alike("x", "y")).select("a", "b", "place")


def leaders(titles: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, leader) of every title that does not lead itself."""
    with_checkpoints(pairs.sparkSession)
    edges = pairs.checkpoint()
    open_ = edges.select("a", "b")
    members = None
    while not open_.isEmpty():
        lead = open_.select("a").distinct().join(open_.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        fresh = open_.join(lead, "a", "left_semi").select("b").distinct().checkpoint()
        members = fresh if members is None else members.union(fresh)
        gone = fresh.withColumnRenamed("b", "id")
        open_ = open_.join(gone.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_anti").select("a", "b").checkpoint()
    if members is None:
        return edges.select(F.col("b").alias("id"), F.col("a").alias("leader")).limit(0)
    led = edges.join(members, "b", "left_semi").join(members.withColumnRenamed("b", "a"), "a", "left_anti")
    return led.groupBy("b").agg(F.min_by("a", "place").alias("leader")).withColumnRenamed("b", "id")


def group_titles(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``scored`` (ord, publisher, title, score and more) with ``leader``, the ord of its group's first."""
    with_checkpoints(scored.sparkSession)
    norm = scored.select("ord", "publisher", "title", "score", normalize_title(F.coalesce("title", F.lit(""))).alias("norm"))
    place = F.struct((-F.col("score")).alias("s"), F.col("title").alias("t"), F.col("ord").alias("o"))
    # Equal titles of a publisher go behind the first of them.
    firsts = norm.groupBy("publisher", "norm").agg(F.min(place).alias("place")).select("publisher", "norm", "place", F.col("place.o").alias("id")).checkpoint()
    led = leaders(firsts, similar_titles(firsts, threshold))
    key = firsts.join(led, "id", "left").select(F.col("publisher").alias("_p"), F.col("norm").alias("_n"), F.coalesce("leader", "id").alias("leader"))
    with_norm = scored.withColumn("_norm", normalize_title(F.coalesce("title", F.lit(""))))
    return with_norm.join(key, F.col("publisher").eqNullSafe(F.col("_p")) & (F.col("_norm") == F.col("_n"))).drop("_p", "_n", "_norm")


def cluster_key(source_name: Column, fixed: str | None, leader: Column) -> Column:
    """Records of the fixed source form one cluster; others go with their leader."""
    return F.when(source_name == fixed, F.lit("fixed")).otherwise(leader.cast("string")) if fixed else leader.cast("string")


def roll_up(grouped: DataFrame, *, fixed: str | None = None, fixed_title: str | None = None, bonus: int = 3) -> DataFrame:
    """One candidate per cluster from (ord, leader, score, title, source_name, ...) rows.

    Members are ordered by score and title, those of the fixed cluster by date.  The best
    member by score, the first of equals, lends title and routes, but for ``fixed_title``;
    the id is made of the title and the first member's date; the date is the earliest.
    """
    rows = grouped.withColumn("cluster", cluster_key(F.col("source_name"), fixed, F.col("leader")))
    by_date = F.when(F.col("cluster") == "fixed", F.coalesce("published_at", F.lit("0001-01-01").cast("timestamp")))
    best_first = F.struct((-F.col("score")).alias("s"), by_date.alias("d"), F.col("title").alias("t"), F.col("ord").alias("o"))
    first = F.struct(by_date.alias("d"), F.when(by_date.isNull(), -F.col("score")).alias("s"), F.col("title").alias("t"), F.col("ord").alias("o"))
    distinct = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.struct(first.alias("k"), F.col(c).alias("v")))), lambda x: x["v"])
    best = F.min_by(F.struct("title", "primary_route", "secondary_routes", "score", "source_id"), best_first)
    out = rows.groupBy("cluster").agg(
        best.alias("best"),
        F.min_by("published_at", first).alias("lead_published"),
        F.min("published_at").alias("published_at"),
        listed("source_id").alias("source_ids"),
        listed("canonical_url").alias("source_urls"),
        distinct("signals").alias("matched_signals"),
        *([distinct("negative").alias("negative_signals")] if "negative" in rows.columns else []),
        F.count("*").alias("source_count"),
    )
    is_fixed = F.col("cluster") == "fixed"
    title = F.when(is_fixed, F.lit(fixed_title)).otherwise(F.col("best.title")) if fixed_title else F.col("best.title")
    return out.select(
        candidate_id(title, iso(F.col("lead_published"))).alias("candidate_id"),
        title.alias("canonical_title"),
        F.col("best.primary_route").alias("primary_route"),
        F.col("best.secondary_routes").alias("secondary_routes"),
        (F.col("best.score") + F.when(is_fixed, bonus).otherwise(0)).alias("score"),
        F.when(is_fixed, "track.fixed").otherwise("track.emerging").alias("track"),
        F.col("best.source_id").alias("primary_source_id"),
        "source_ids",
        "source_urls",
        "published_at",
        "matched_signals",
        *(["negative_signals"] if "negative" in rows.columns else []),
        F.col("source_count").cast("int").alias("source_count"),
        F.when(is_fixed, "fixed_cluster").when(F.col("source_count") > 1, "near_title").otherwise("single").alias("method"),
    )

