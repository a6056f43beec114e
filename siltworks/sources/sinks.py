"""Sinks: tables by Spark's writers, small reports from bounded frames."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame

#: Reports are made of at most this many rows; a larger frame is an error, not a cut.
MAX_REPORT_ROWS = 5_000


def write_run(df: DataFrame, path: str, run_id: str, format: str = "parquet") -> None:
    """A run's table in its own folder; writing it again replaces it as a whole."""
    df.write.mode("overwrite").format(format).save(f"{path}/run_id={run_id}")


def write_bronze(df: DataFrame, path: str) -> None:
    """Source records by source, so that reading some sources reads only their folders."""
    df.write.mode("append").partitionBy("registry_id").parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def report_rows(df: DataFrame) -> list:
    rows = df.limit(MAX_REPORT_ROWS + 1).collect()
    if len(rows) > MAX_REPORT_ROWS:
        raise ValueError(f"a report takes at most {MAX_REPORT_ROWS} rows")
    return rows


def markdown_table(df: DataFrame, title: str) -> str:
    """A heading, the number of rows and a table; cell text is escaped."""
    cell = lambda v: "" if v is None else str(v).replace("\\", "\\\\").replace("|", "\\|").replace("\n", " ")
    rows = report_rows(df)
    lines = [f"# {title}", "", f"{len(rows)} rows", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(cell(v) for v in r) + " |" for r in rows)]) + "\n"


def event_report(events: DataFrame, days: DataFrame, top: int = 5) -> str:
    """Top events, the others and the timeline; ``events`` comes from ``ranked_events``."""
    rows = sorted(report_rows(events), key=lambda r: r["rank"])
    lines = ["# Verified events", ""]
    for head, part in (("Top events", rows[:top]), ("Other events", rows[top:])):
        lines += [f"## {head}", "", *(f"{r['rank']}. {r['canonical_title']}: {r['fact_summary']}" for r in part), ""]
    lines += ["## Timeline", "", *(f"- {d['label']}: {d['events']} {d['categories']}".rstrip() for d in sorted(report_rows(days), key=lambda d: d["day"]))]
    return "\n".join(lines) + "\n"


def run_report(run_id: str, history: list[str], sizes: dict[str, int]) -> str:
    """The states a run went through and how many rows each of its tables has."""
    return "\n".join([f"# Run {run_id}", "", "States: " + ", ".join(history), "", *(f"- {name}: {n}" for name, n in sizes.items()), ""])


def review_instructions(run_id: str, queued: int) -> str:
    return "\n".join([f"# Review of {run_id}", "", f"{queued} candidates wait.", "", "1. Check each primary source and set verification_status.", "2. Give every candidate claims with text, kind and locator, a limitation, a decision and its reason.", "3. Set review_status to approved, with verified_at and verified_by.", ""])


def embed_json(page: str, data, begin: str, end: str) -> str:
    """``page`` with the JSON between two markers that must each occur once; ``<`` is escaped."""
    if page.count(begin) != 1 or page.count(end) != 1 or page.index(begin) > page.index(end):
        raise ValueError("the markers must each occur once, in order")
    text = json.dumps(data, ensure_ascii=False, default=str).replace("<", "\\u003c")
    return page[: page.index(begin) + len(begin)] + text + page[page.index(end) :]
