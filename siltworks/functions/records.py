"""Projections to the common source record, and excerpts around configured terms."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import ids, text, times, urls

SCHEMA_VERSION = "0.2"
SOURCE_RECORD = (
    "schema_version record_type source_id registry_id source_type source_name publisher author source_url canonical_url raw_title raw_text raw_excerpt "
    "published_at collected_at language content_hash access_status http_status failure_reason discovered_by discovery_context rights_scope processing_status"
).split()
UNTITLED = "Untitled source"


def to_source_record(df: DataFrame, **given: Column) -> DataFrame:
    """The 24 fields of a source record, from columns of the same name or from ``given``.

    Fields that are in neither take their defaults: untitled, success, excerpt rights,
    found by the registry; id, hash, language and processing status are derived.
    """
    have = set(df.columns)

    def field(name: str, kind: str = "string", default: Column | None = None) -> Column:
        value = given.get(name, F.col(name) if name in have else F.lit(None))
        value = value.cast(kind)
        return value if default is None else F.coalesce(value, default)

    base = df.select(
        "*",
        urls.canonicalize_url(given.get("source_url", F.col("source_url") if "source_url" in have else F.col("url"))).alias("_canonical"),
        F.coalesce(F.nullif(F.btrim(given.get("raw_title", F.col("raw_title") if "raw_title" in have else F.lit(None).cast("string"))), F.lit("")), F.lit(UNTITLED)).alias("_title"),
    )
    body, short = field("raw_text"), field("raw_excerpt")
    status = field("access_status", default=F.lit("success"))
    return base.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit("source_record").alias("record_type"),
        ids.stable_id(F.col("_canonical")).alias("source_id"),
        field("registry_id").alias("registry_id"),
        field("source_type").alias("source_type"),
        field("source_name").alias("source_name"),
        field("publisher").alias("publisher"),
        field("author", "array<string>", F.array().cast("array<string>")).alias("author"),
        given.get("source_url", F.col("source_url") if "source_url" in have else F.col("url")).alias("source_url"),
        F.col("_canonical").alias("canonical_url"),
        F.col("_title").alias("raw_title"),
        body.alias("raw_text"),
        short.alias("raw_excerpt"),
        field("published_at", "timestamp").alias("published_at"),
        field("collected_at", "timestamp").alias("collected_at"),
        text.language_hint(F.concat_ws(" ", F.col("_title"), F.coalesce(short, F.lit(""))), field("language")).alias("language"),
        ids.content_hash(F.col("_title"), body, short).alias("content_hash"),
        status.alias("access_status"),
        field("http_status", "int").alias("http_status"),
        field("failure_reason").alias("failure_reason"),
        field("discovered_by", default=F.lit("registry")).alias("discovered_by"),
        field("discovery_context").alias("discovery_context"),
        field("rights_scope", default=F.lit("excerpt")).alias("rights_scope"),
        F.when(status == "success", "collected").otherwise("needs_review").alias("processing_status"),
    )


def article_payload(payload: Column) -> Column:
    """struct(url, title, body, author, published_at, rights_scope) of an extractor's JSON text.

    Several names are tried for each field; a body may be a string, a list of strings
    or a list of objects with a text; a single author becomes a list.
    """
    first = lambda *paths: F.coalesce(*[F.nullif(F.get_json_object(payload, p), F.lit("")) for p in paths])
    listed = F.from_json(F.get_json_object(payload, "$.texts"), "array<string>")
    inner = F.transform(listed, lambda t: F.coalesce(F.get_json_object(t, "$.text"), F.get_json_object(t, "$.content"), t))
    body = F.coalesce(F.nullif(F.array_join(inner, "\n"), F.lit("")), first("$.content", "$.text", "$.body"))
    author = first("$.author", "$.authors", "$.meta_info.author_name")
    authors = F.coalesce(F.when(author.startswith("["), F.from_json(author, "array<string>")), F.when(author.isNotNull(), F.array(author)), F.array().cast("array<string>"))
    return F.struct(
        first("$.url", "$.news_url", "$.link").alias("url"),
        first("$.title", "$.news_title").alias("title"),
        body.alias("body"),
        authors.alias("author"),
        times.parse_iso_datetime(first("$.published_at", "$.publish_time", "$.meta_info.publish_time")).alias("published_at"),
        F.when(body.isNotNull(), "internal_text").otherwise("metadata_only").alias("rights_scope"),
    )


def focused_excerpt(pages: Column, terms: list[str], *, max_pages: int = 5, before: int = 240, window: int = 1500, most: int = 6000) -> Column:
    """Windows of the pages that name the terms, best page first, each with its page number.

    A page counts the words of its terms; ties go to more terms, then to the earlier
    page.  The window starts before the longest term's first place.  Without any term
    the first two pages with text stand in.
    """
    listed = F.array(*[F.struct(F.lit(-max(1, len(t.split()))).alias("w"), F.lit(t.lower()).alias("t")) for t in terms])

    def of(page: Column, i: Column) -> Column:
        low = F.lower(page)
        hits = F.array_sort(F.filter(F.transform(listed, lambda x: F.struct(x["w"].alias("w"), F.instr(low, x["t"]).alias("at"))), lambda h: h["at"] > 0))
        return F.struct(F.aggregate(hits, F.lit(0), lambda a, h: a + h["w"]).alias("weight"), (-F.size(hits)).alias("n"), (i + 1).alias("page"), F.coalesce(F.get(hits, F.lit(0))["at"], F.lit(1)).alias("at"), page.alias("text"))

    every = F.transform(pages, of)
    named = F.array_sort(F.filter(every, lambda p: p["n"] < 0))
    fallback = F.filter(every, lambda p: (p["page"] <= 2) & (p["text"] != ""))
    chosen = F.slice(F.when(F.size(named) > 0, named).otherwise(fallback), 1, max_pages)
    piece = F.transform(chosen, lambda p: F.concat(F.lit("[Page "), p["page"].cast("string"), F.lit("] "), F.substr(p["text"], F.greatest(F.lit(1), p["at"] - before), F.lit(window))))
    return F.substring(F.array_join(piece, "\n\n"), 1, most)


def focus_context(terms: Column) -> Column:
    """``watchlist_focus:a,b`` of the non-empty terms, or an empty string."""
    kept = F.filter(F.transform(terms, lambda t: F.btrim(t)), lambda t: t != "")
    return F.when(F.size(kept) > 0, F.concat(F.lit("watchlist_focus:"), F.array_join(kept, ","))).otherwise("")


def _seen_as(format: str) -> str:
    """A pattern of the texts that a date format may fit; what it finds is parsed afterwards."""
    parts = {"yyyy": r"\d{4}", "MMMM": r"\p{L}{3,9}", "MMM": r"\p{L}{3,4}", "M": r"\d{1,2}", "d": r"\d{1,2}", " ": r"\s+"}
    return re.sub("yyyy|M+|d| |[^\\w\\s]", lambda m: parts.get(m[0]) or re.escape(m[0]), format)


VISIBLE_DATE = r"\b(?:" + "|".join(map(_seen_as, times.DATE_FORMATS)) + r")\b"


def first_date(fragment: Column) -> Column:
    """The first visible date of a piece of a page that parses."""
    said = F.coalesce(text.clean_html(fragment), F.lit(""))
    seen = F.regexp_extract_all(said, F.lit(VISIBLE_DATE), F.lit(0))
    # Mostly the first date seen is one; the others are looked for where it is not.
    return F.coalesce(times.parse_publication_date(F.regexp_extract(said, VISIBLE_DATE, 0)), F.get(F.filter(F.transform(seen, times.parse_publication_date), lambda d: d.isNotNull()), F.lit(0)))


def nearby_date(page: Column, start: Column, end: Column, reach: int = 700) -> Column:
    """The first date that parses after an anchor, or else before it (positions from 0)."""
    low = F.greatest(F.lit(0), start - reach)
    return F.coalesce(first_date(F.substr(page, end + 1, F.lit(reach))), first_date(F.substr(page, low + 1, start - low)))
