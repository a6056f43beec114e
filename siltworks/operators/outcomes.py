"""What became of a run's records: set aside and why, marked down, kept, recalled, counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.operators import summaries


def _held() -> Column:
    return F.size("hard") > 0


def _marks() -> dict[str, tuple[Column, Column]]:
    """What a scored record may be, with the terms that made it so."""
    none = F.array().cast("array<string>")
    return {
        "excluded": (_held(), F.col("hard")),
        "unrouted": (~_held() & F.col("primary_route").isNull(), none),
        "demoted": (~_held() & (F.size("negative") > 0), F.col("negative")),
    }


def exclusions(scored: DataFrame, key: str = "source_id", title: str = "title") -> DataFrame:
    """(key, title, reason, terms): records with a hard term, without a route, or marked down.

    A record that is marked down stays in the run unless it has no route either: then it
    has two rows.  One narrow pass over the scored records.
    """
    rows = [F.when(is_so, F.struct(F.lit(reason).alias("reason"), terms.alias("terms"))) for reason, (is_so, terms) in _marks().items()]
    return scored.select(F.col(key), F.col(title), F.inline(F.filter(F.array(*rows), lambda x: x.isNotNull())))


def counts(scored: DataFrame) -> DataFrame:
    """One row: scored records, excluded, demoted, unrouted and routed ones."""
    marks = {reason: F.count_if(is_so).alias(reason) for reason, (is_so, _) in _marks().items()}
    routed = F.count_if(~_held() & F.col("primary_route").isNotNull()).alias("routed")
    return scored.agg(F.count("*").alias("scored"), marks["excluded"], marks["demoted"], marks["unrouted"], routed)


def recall(expected: list[str], readable: DataFrame, candidates: DataFrame, title: str = "raw_title") -> DataFrame:
    """(title, present, selected) of each expected title; ``expected`` is part of the configuration, so small."""
    spark = readable.sparkSession
    wanted = spark.createDataFrame([(t,) for t in expected], "title string")
    # Only rows of an expected title are shuffled.
    among = lambda df, c: df.select(F.col(c).alias("title")).filter(F.col("title").isin(*expected) if expected else F.lit(False))
    return summaries.recall(wanted, among(readable, title), among(candidates.filter("status = 'selected'"), "canonical_title"), "title")


def report(records: DataFrame, scored: DataFrame, candidates: DataFrame, recalled: DataFrame) -> DataFrame:
    """(figure, of, n): sizes of each step, members collapsed by method, selected by type and route, recall."""

    def figures(row: DataFrame) -> DataFrame:
        parts = [F.struct(F.lit(c).alias("figure"), F.lit(None).cast("string").alias("of"), F.col(c).cast("bigint").alias("n")) for c in row.columns]
        return row.select(F.inline(F.array(*parts)))

    selected = candidates.filter("status = 'selected'")
    by = lambda df, figure, key, n: df.groupBy(key).agg(n.cast("bigint").alias("n")).select(F.lit(figure).alias("figure"), F.col(key).alias("of"), "n")
    parts = [
        figures(records.agg(F.count("*").alias("input_records"))),
        figures(counts(scored)),
        figures(candidates.agg(F.count("*").alias("candidates"), F.count_if(F.col("status") == "selected").alias("selected"))),
        figures(recalled.agg(F.count_if("present").alias("recall_present"), F.count_if("selected").alias("recall_selected"))),
        by(candidates, "collapsed", "method", F.sum(F.col("source_count") - 1)),
        by(selected, "selected_by_type", "type", F.count("*")),
        by(selected, "selected_by_route", "route", F.count("*")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
