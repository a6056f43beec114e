"""Articles behind discovered addresses: what was landed for each address is joined to the entry that named it.

Every entry has an outcome: an article, nothing (the article lies outside the window), or a
failure of its own that does not touch the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import ids, records, times
from siltworks.operators.predicates import in_window, passes_terms
from siltworks.sources.landed import meta_elements, meta_said, unescape

#: What an entry may say about its article's provenance, in place of the registry's words.
OVERRIDES = ("source_name", "publisher", "discovered_by", "discovery_context")


def landed_once(landed: DataFrame, body: str) -> DataFrame:
    """(asked, body, reason): of an address's results the latest with a body, else the latest reason.

    ``landed`` has url, ``attempt``, the body and ``reason``.  max keeps one row of a hot address in each task.
    """
    has = F.btrim(F.coalesce(body, F.lit(""))) != ""
    best = landed.filter("url is not null").groupBy(F.col("url").alias("asked")).agg(
        F.max(F.when(has, F.struct("attempt", F.col(body).alias("body")))).alias("good"), F.max(F.when(~has, F.struct("attempt", F.col("reason").alias("reason")))).alias("bad")
    )
    return best.select("asked", F.col("good.body").alias("body"), F.when(F.col("good").isNull(), F.coalesce("bad.reason", F.lit("no result"))).alias("reason"))


def _joined(entries: DataFrame, landed: DataFrame, body: str) -> DataFrame:
    """Entries with ``body`` and ``failure``, null where a body was landed."""
    told = [c if c in entries.columns else F.lit(None).cast("string").alias(c) for c in OVERRIDES]
    mine = entries.select("registry_id", "place", F.col("url").alias("asked"), *[c for c in ("name",) if c in entries.columns], *told)
    return mine.join(landed_once(landed, body), "asked", "left").withColumn("failure", F.when(F.col("body").isNull(), F.coalesce("reason", F.lit("not fetched")))).drop("reason")


def extracted(entries: DataFrame, payloads: DataFrame, start: Column, end: Column) -> DataFrame:
    """Articles of extractor JSON for the chosen entries (registry_id, place, url, overrides).

    ``payloads`` has url (the one asked for), attempt, payload and reason.  An entry without a
    result, or whose result names no address, is a failed row; an article outside the window, or
    without a date, gives none.
    What an entry says of its provenance wins over the registry.
    """
    read = _joined(entries, payloads, "payload").withColumn("a", records.article_payload(F.col("body")))
    why = F.coalesce("failure", F.when(F.col("a.url").isNull(), "the result has no address"))
    read = read.withColumn("why", why).filter(F.col("why").isNotNull() | in_window(F.col("a.published_at"), start, end))
    ok = lambda c: F.when(F.col("why").isNull(), c)
    return read.select(
        "registry_id",
        "place",
        F.coalesce(ok(F.col("a.url")), "asked").alias("url"),
        ok(F.coalesce("a.title", F.lit("Untitled article"))).alias("raw_title"),
        ok(F.col("a.body")).alias("raw_text"),
        ok(F.col("a.author")).alias("author"),
        ok(F.col("a.published_at")).alias("published_at"),
        F.when(F.col("why").isNull(), F.col("a.rights_scope")).otherwise("metadata_only").alias("rights_scope"),
        F.when(F.col("why").isNull(), "success").otherwise("failed").alias("access_status"),
        F.col("why").alias("failure_reason"),
        *OVERRIDES,
    )


def listed(items: DataFrame, pages: DataFrame, start: Column, end: Column, keywords: list[str] = (), *, author: str | None = None) -> DataFrame:
    """Articles of a list's items (registry_id, place, url, name) by the meta elements of their landed pages (url, attempt, body, reason).

    The title is the meta elements', else the list's name, else the page's title element; kept are
    articles in the window with some keyword in title or excerpt (all where none is named).  An
    item without a page is a failed row.
    """
    read = _joined(items, pages, "body")
    # A generator's columns are worked out once: no filter or projection above repeats the search of the page.
    titled = F.nullif(F.btrim(F.regexp_extract("body", r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)), F.lit(""))
    read = read.select("registry_id", "place", "asked", "name", "failure", F.inline(F.array(F.struct(meta_elements(F.col("body")).alias("m"), titled.alias("titled")))))
    m = F.col("m")
    told = F.struct(
        F.coalesce(meta_said(m, "og:title"), F.nullif(F.col("name"), F.lit("")), unescape(F.col("titled")), F.lit("Untitled article")).alias("t"),
        meta_said(m, "og:description", "description").alias("x"),
        times.parse_iso_datetime(meta_said(m, "article:published_time")).alias("at"),
        F.coalesce(meta_said(m, "article:author"), F.lit(author)).alias("by"),
    )
    said = read.select("registry_id", "place", "asked", "failure", F.inline(F.array(told)))
    failed = F.col("failure").isNotNull()
    kept = said.filter(failed | (in_window(F.col("at"), start, end) & passes_terms(F.concat_ws(" ", "t", "x"), list(keywords))))
    ok = lambda c: F.when(~failed, c)
    return kept.select(
        "registry_id",
        "place",
        F.col("asked").alias("url"),
        ok(unescape(F.col("t"))).alias("raw_title"),
        ok(unescape(F.col("x"))).alias("raw_excerpt"),
        ok(F.when(F.col("by").isNotNull(), F.array("by")).otherwise(F.array().cast("array<string>"))).alias("author"),
        ok(F.col("at")).alias("published_at"),
        F.when(failed, "failed").otherwise("success").alias("access_status"),
        F.col("failure").alias("failure_reason"),
    )


def health(entries: DataFrame, made: DataFrame, scanned: DataFrame) -> DataFrame:
    """One row a source of ``scanned`` (registry_id, scanned): chosen, accepted, failed, and whether the source failed as a whole.

    A source fails where something was chosen and no entry succeeded or was merely out of the window.
    """
    chosen = entries.groupBy("registry_id").agg(F.count("*").alias("selected"))
    got = made.groupBy("registry_id").agg(F.count_if(F.col("access_status") == "success").alias("accepted"), F.count_if(F.col("access_status") == "failed").alias("extraction_failures"), F.min("failure_reason").alias("error"))
    rows = scanned.join(chosen, "registry_id", "left").join(got, "registry_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    whole = (F.coalesce("selected", F.lit(0)) > 0) & (F.coalesce("extraction_failures", F.lit(0)) >= F.coalesce("selected", F.lit(0)))
    return rows.select("registry_id", F.when(whole, "failed").otherwise("success").alias("status"), zero("scanned"), zero("selected"), zero("accepted"), zero("extraction_failures"), "error")


def attach_pdf(records_: DataFrame, read: DataFrame) -> DataFrame:
    """Records whose PDF was read get its text, in the columns of ``records_``.

    ``read`` is what ``landed.pdf_text`` gives, with url for path.  Records that succeeded and whose
    address ends in ``.pdf`` take part.  Text, excerpt, content hash, rights, processing status
    and context follow; a PDF that failed leaves the record for review with its text unchanged.
    Of an address's readings a success wins, then the longest text; rows are never multiplied.
    """
    best = read.groupBy(F.col("url").alias("_u")).agg(F.max(F.struct((F.col("status") == "success").alias("ok"), F.length("full_text").alias("n"), "full_text", "excerpt", F.col("n_pages").alias("pages"))).alias("_p"))
    path = F.lower(F.regexp_replace(F.coalesce("canonical_url", F.lit("")), r"[?#].*$", ""))
    both = records_.join(best, F.col("canonical_url") == F.col("_u"), "left")
    mine = F.coalesce(F.col("access_status") == "success", F.lit(False)) & path.endswith(".pdf")
    ok, bad = mine & F.coalesce(F.col("_p.ok"), F.lit(False)), mine & ~F.coalesce(F.col("_p.ok"), F.lit(False))
    context = F.concat_ws("; ", F.nullif(F.col("discovery_context"), F.lit("")), F.concat(F.lit("pdf_pages:"), F.col("_p.pages").cast("string")))
    new = {
        "raw_text": F.when(ok, F.col("_p.full_text")).otherwise(F.col("raw_text")),
        "raw_excerpt": F.when(ok, F.col("_p.excerpt")).otherwise(F.col("raw_excerpt")),
        "content_hash": F.when(ok, ids.content_hash(F.col("raw_title"), F.col("_p.full_text"), F.col("_p.excerpt"))).otherwise(F.col("content_hash")),
        "rights_scope": F.when(ok, "primary_source_internal_text").otherwise(F.col("rights_scope")),
        "processing_status": F.when(ok, "text_extracted").when(bad, "pdf_text_needs_review").otherwise(F.col("processing_status")),
        "discovery_context": F.when(ok, context).otherwise(F.col("discovery_context")),
    }
    return both.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in records_.columns])


def changed_pages(entries: DataFrame, start: Column, end: Column, include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """Entries of ``landed.sitemap`` by terms of the address and window of change, as source-record columns.

    The date is of modification, which the excerpt and the context say.
    """
    kept = entries.filter(passes_terms(F.col("url"), list(include), list(exclude)) & in_window(F.col("modified_at"), start, end))
    return kept.select("registry_id", "place", "url", F.col("title").alias("raw_title"), F.col("modified_at").alias("published_at"), F.concat(F.lit("The sitemap says that this page changed at "), times.iso(F.col("modified_at")), F.lit(".")).alias("raw_excerpt"), F.lit("metadata_only").alias("rights_scope"), F.lit("date_semantics:last_modified").alias("discovery_context"))
