"""Every query over the driver's tables, with the DuckDB SQL that checks it.

The tables hold no news, so operators run over analogues: ``pages`` for landed pages,
``documents`` for records (``source`` is the publisher, the first line the title),
``events`` for dated events (``event_type`` is the route), ``orders`` and ``lineitem``
for quotas and references.  All run over whole tables and whole texts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import ids, records, scoring, text, times, urls
from siltworks.operators import cluster, dedupe, editorial, joins, outcomes, predicates, select, summaries, validate
from siltworks.sources import landed

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- pages

SQL_PART = r"regexp_extract(trim(url), '^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$', {})"
SQL_URL = (
    "(CASE WHEN lower({1}) = '' THEN '' ELSE lower({1}) || ':' END || CASE WHEN {2} = '' THEN '' ELSE '//' || lower({2}) END || "
    "CASE WHEN regexp_replace({3}, '/+$', '') = '' THEN '/' ELSE regexp_replace({3}, '/+$', '') END || "
    "CASE WHEN len(list_filter(string_split({4}, '&'), lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_') AND lower(split_part(p, '=', 1)) NOT IN ('fbclid', 'gclid', 'ref', 'source', 'spm'))) = 0 THEN '' "
    "ELSE '?' || array_to_string(list_filter(string_split({4}, '&'), lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_') AND lower(split_part(p, '=', 1)) NOT IN ('fbclid', 'gclid', 'ref', 'source', 'spm')), '&') END)"
).format("", *[SQL_PART.format(i) for i in range(1, 5)])
SQL_CLEAN = r"nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), '')"
SQL_TITLE = r"coalesce(nullif(trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)), ''), 'Untitled source')"
SQL_STATUS = "CASE WHEN page_id % 7 = 0 THEN 'failed' WHEN page_id % 5 = 0 THEN 'blocked' WHEN page_id % 3 = 0 THEN 'partial' ELSE 'success' END"


def page_status(page_id: Column) -> Column:
    return F.when(page_id % 7 == 0, "failed").when(page_id % 5 == 0, "blocked").when(page_id % 3 == 0, "partial").otherwise("success")


@query("url_canonical", f"SELECT page_id, {SQL_URL} AS canonical_url, 'src_' || substr(sha256({SQL_URL}), 1, 20) AS source_id, regexp_matches(url, '^(?i:https?)://[^/?#]+') AS valid FROM pages")
def url_canonical(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").withColumn("canonical_url", urls.canonicalize_url(url)).select("page_id", "canonical_url", ids.stable_id(F.col("canonical_url")).alias("source_id"), urls.valid_url(url).alias("valid"))


@query("html_clean", f"SELECT page_id, {SQL_CLEAN} AS clean_text, CAST(length({SQL_CLEAN}) AS INTEGER) AS n_chars, CASE WHEN regexp_matches({SQL_CLEAN}, '[\\x{{4e00}}-\\x{{9fff}}]') THEN 'zh-CN' ELSE 'und' END AS language FROM pages")
def html_clean(spark, sf_dir):
    clean = table(spark, sf_dir, "pages").select("page_id", text.clean_html(F.col("html")).alias("clean_text"))
    return clean.select("page_id", "clean_text", F.length("clean_text").alias("n_chars"), text.language_hint(F.col("clean_text")).alias("language"))


@query("url_slugs", "SELECT page_id, substr(trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_'), 1, 36) AS slug, CASE WHEN contains(lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)), 'blog.') THEN 'Blog' WHEN contains(lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)), 'm.') THEN 'Mobile' ELSE 'Source' END AS label, replace(replace(url, 'http://', 'https://'), '://m.', '://www.') AS rewritten FROM pages")
def url_slugs(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.slug(url).alias("slug"), urls.source_label(url, [("blog.", "Blog"), ("m.", "Mobile")]).alias("label"), urls.rewrite_url(url, [("http://", "https://"), ("://m.", "://www.")]).alias("rewritten"))


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as source records with ``ord``, before deduplication."""
    pages = table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    base = pages.select(F.col("page_id").alias("ord"), F.col("url").alias("source_url"), title.alias("raw_title"), text.clean_html(F.col("html")).alias("raw_text"), page_status(F.col("page_id")).alias("access_status"), F.lit("company_news").alias("source_type"), urls.host(F.col("url")).alias("source_name"), F.lit("pages").alias("registry_id"), F.lit("2024-01-31").cast("timestamp").alias("collected_at"))
    base = base.withColumn("failure_reason", F.when(F.col("access_status").isin("failed", "blocked"), "not readable"))
    # The page's number travels in the discovery context and comes back as the order.
    made = records.to_source_record(base, raw_excerpt=F.col("raw_text"), discovery_context=F.col("ord").cast("string"))
    return made.withColumn("ord", F.col("discovery_context").cast("bigint"))


SQL_RECORDS = f"""
SELECT page_id AS ord, {SQL_URL} AS canonical_url, 'src_' || substr(sha256({SQL_URL}), 1, 20) AS source_id, {SQL_TITLE} AS raw_title, {SQL_STATUS} AS access_status,
  sha256({SQL_TITLE} || chr(10) || coalesce({SQL_CLEAN}, '') || chr(10) || coalesce({SQL_CLEAN}, '')) AS content_hash,
  CASE WHEN {SQL_STATUS} = 'success' THEN 'collected' ELSE 'needs_review' END AS processing_status
FROM pages"""


@query(
    "source_records",
    f"SELECT * FROM ({SQL_RECORDS}) QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY CASE access_status WHEN 'success' THEN 3 WHEN 'partial' THEN 2 WHEN 'blocked' THEN 1 ELSE 0 END DESC, ord) = 1",
)
def source_records(spark, sf_dir):
    """Landed pages to deduplicated source records: the flagship batch."""
    return dedupe.best_access(page_records(spark, sf_dir)).select("ord", "canonical_url", "source_id", "raw_title", "access_status", "content_hash", "processing_status")


@query(
    "dedupe_best_access",
    "SELECT host, ord, access_status FROM (SELECT lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)) AS host, page_id AS ord, " + SQL_STATUS + " AS access_status FROM pages) QUALIFY row_number() OVER (PARTITION BY host ORDER BY CASE access_status WHEN 'success' THEN 3 WHEN 'partial' THEN 2 WHEN 'blocked' THEN 1 ELSE 0 END DESC, ord) = 1",
)
def dedupe_best_access(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(urls.host(F.col("url")).alias("canonical_url"), F.col("page_id").alias("ord"), page_status(F.col("page_id")).alias("access_status"))
    return dedupe.best_access(rows).select(F.col("canonical_url").alias("host"), "ord", "access_status")


@query(
    "run_summary",
    f"SELECT count(*) AS records, count(*) FILTER (s = 'success') AS success, count(*) FILTER (s = 'partial') AS partial, count(*) FILTER (s = 'blocked') AS blocked, count(*) FILTER (s = 'failed') AS failed, CAST(0 AS BIGINT) AS dated, count(DISTINCT h) AS sources FROM (SELECT {SQL_STATUS} AS s, lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)) AS h FROM pages)",
)
def run_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(page_status(F.col("page_id")).alias("access_status"), urls.host(F.col("url")).alias("source_name"), F.lit(None).cast("timestamp").alias("published_at"))
    return summaries.run_summary(rows)


@query(
    "record_violations",
    f"WITH r AS ({SQL_RECORDS}) SELECT 'duplicate_id' AS rule, source_id AS key FROM r GROUP BY source_id HAVING count(*) > 1 UNION ALL SELECT 'duplicate_url', canonical_url FROM r GROUP BY canonical_url HAVING count(*) > 1",
)
def record_violations(spark, sf_dir):
    return validate.source_records(page_records(spark, sf_dir))


# ---------------------------------------------------------------- events

WINDOW = ("2024-01-10 00:00:00", "2024-01-17 12:00:00")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("window_filter", f"SELECT event_id, event_type FROM events WHERE ts BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'")
def window_filter(spark, sf_dir):
    return events(spark, sf_dir).filter(predicates.in_window(F.col("ts"), *[F.lit(w).cast("timestamp") for w in WINDOW])).select("event_id", "event_type")


@query("calendar_window", f"SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{WINDOW[0][:10]}' AND DATE '{WINDOW[1][:10]}'")
def calendar_window(spark, sf_dir):
    return events(spark, sf_dir).filter(predicates.in_calendar_window(F.col("ts"), *[F.lit(w).cast("timestamp") for w in WINDOW])).select("event_id", "event_type")


@query(
    "time_parsing",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') END || 'Z' AS iso, CAST(CAST(ts AS DATE) AS VARCHAR) AS d1, CAST(CAST(ts AS DATE) AS VARCHAR) AS d2, 'issue_' || CAST(isoyear(ts) AS VARCHAR) || '_w' || lpad(CAST(weekofyear(ts) AS VARCHAR), 2, '0') AS issue_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS millis FROM events",
)
def time_parsing(spark, sf_dir):
    day = F.to_date("ts")
    seconds = F.unix_seconds("ts")
    date_text = lambda f: F.to_date(times.parse_publication_date(F.date_format("ts", f))).cast("string")
    return events(spark, sf_dir).select("event_id", times.iso(F.col("ts")).alias("iso"), date_text("yyyy.M.d").alias("d1"), date_text("MMMM d, yyyy").alias("d2"), ids.issue_id(day).alias("issue_id"), F.unix_seconds(times.unix_datetime(seconds.cast("string"))).alias("seconds"), F.unix_seconds(times.unix_datetime((seconds * 1000).cast("string"))).alias("millis"))


@query(
    "json_coalesce",
    "SELECT event_id, coalesce(nullif(json_extract_string(props, '$.title'), ''), nullif(json_extract_string(props, '$.page'), ''), nullif(json_extract_string(props, '$.k'), ''), event_type) AS label, length(props) AS n FROM events",
)
def json_coalesce(spark, sf_dir):
    got = lambda p: F.nullif(F.get_json_object("props", p), F.lit(""))
    return events(spark, sf_dir).select("event_id", F.coalesce(got("$.title"), got("$.page"), got("$.k"), F.col("event_type")).alias("label"), F.length("props").cast("bigint").alias("n"))


@query(
    "source_health",
    f"SELECT event_type AS registry_id, count(*) AS scanned, count(*) FILTER (value > 10) AS eligible, count(*) FILTER (value > 10 AND ts BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}') AS accepted FROM events GROUP BY 1",
)
def source_health(spark, sf_dir):
    inside = predicates.in_window(F.col("ts"), *[F.lit(w).cast("timestamp") for w in WINDOW])
    return summaries.source_health(events(spark, sf_dir).withColumnRenamed("event_type", "registry_id"), F.lit(True), F.col("value") > 10, (F.col("value") > 10) & inside)


@query("type_histogram", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def type_histogram(spark, sf_dir):
    return summaries.histogram(events(spark, sf_dir), "event_type")


@query("usage_totals", "SELECT CAST(coalesce(sum(user_id), 0) AS BIGINT) AS user_id, CAST(coalesce(sum(CASE WHEN value > 10 THEN event_id END), 0) AS BIGINT) AS large FROM events")
def usage_totals(spark, sf_dir):
    return summaries.usage_totals(events(spark, sf_dir).withColumn("large", F.when(F.col("value") > 10, F.col("event_id"))), "user_id", "large")


@query(
    "trend_radar",
    """WITH c AS (SELECT event_type AS route, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, route LIMIT 4),
    f AS (SELECT event_type AS route, string_agg(CAST(user_id AS VARCHAR), ', ' ORDER BY event_id) AS names FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 3) GROUP BY 1)
    SELECT 'trend_' || substr(sha256(c.route), 1, 12) AS trend_id, c.route, n AS events, names, CASE WHEN n >= 2 THEN 'rising' ELSE 'unconfirmed' END AS status,
      CAST(least(95, 74 + 7 * n) AS INTEGER) AS score, '+' || CASE WHEN 6 + 4 * n < 10 THEN '0' ELSE '' END || CAST(6 + 4 * n AS VARCHAR) AS delta, CAST(least(80, 30 + 12 * n) AS INTEGER) AS maturity, CAST(least(90, 55 + 9 * n) AS INTEGER) AS impact
    FROM c JOIN f ON c.route = f.route""",
)
def trend_radar(spark, sf_dir):
    return editorial.trends(events(spark, sf_dir).withColumn("name", F.col("user_id").cast("string")), route="event_type", name="name")


@query(
    "timeline_7d",
    """WITH d AS (SELECT *, CAST(ts AS DATE) AS d FROM events), s AS (SELECT greatest(max(d), min(d) + 6) AS e FROM d),
    p AS (SELECT d.*, least(e, greatest(e - 6, d)) AS day, e FROM d, s),
    c AS (SELECT day, event_type, min(ts) AS first, count(*) AS n, min(d) AS low, max(d) AS high FROM p GROUP BY 1, 2),
    g AS (SELECT day, sum(n) AS n, min(low) AS low, max(high) AS high, string_agg(event_type, ', ' ORDER BY first, event_type) AS c FROM c GROUP BY 1),
    days AS (SELECT CAST(unnest(generate_series(e - 6, e, INTERVAL 1 DAY)) AS DATE) AS day, e FROM s)
    SELECT CAST(days.day AS VARCHAR) AS day, CASE WHEN low < e - 6 OR high > e THEN strftime(low, '%m.%d') || '-' || strftime(high, '%m.%d') ELSE strftime(days.day, '%m.%d') END AS label,
      CAST(coalesce(n, 0) AS BIGINT) AS events, coalesce(c, '') AS categories FROM days LEFT JOIN g ON days.day = g.day""",
)
def timeline_7d(spark, sf_dir):
    return editorial.timeline(events(spark, sf_dir), at="ts", category="event_type").withColumn("day", F.col("day").cast("string"))


@query(
    "top_events",
    "SELECT event_type, event_id, rank FROM (SELECT event_type, event_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY value DESC, ts, event_id) AS INTEGER) AS rank FROM events) WHERE rank <= 5",
)
def top_events(spark, sf_dir):
    return summaries.top_per_group(events(spark, sf_dir), "event_type", 5, F.col("value").desc(), F.col("ts"), F.col("event_id")).select("event_type", "event_id", "rank")


@query(
    "fallback_overlay",
    f"""WITH e AS (SELECT event_id AS ord, event_type || '/' || CAST(user_id % 50 AS VARCHAR) AS url, event_type AS registry_id, ts, event_id % 2 = 0 AS cur, CASE WHEN event_type IN ('click', 'view') THEN 'failed' WHEN value > 20 THEN 'success' ELSE 'partial' END AS st FROM events),
    c AS (SELECT * FROM e WHERE cur), b AS (SELECT * REPLACE ('success' AS st) FROM e WHERE NOT cur),
    failed AS (SELECT registry_id FROM c GROUP BY 1 HAVING max(CASE st WHEN 'success' THEN 3 WHEN 'partial' THEN 2 ELSE 0 END) <= 0),
    u AS (SELECT * FROM b WHERE registry_id IN (SELECT registry_id FROM failed) AND ts BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'),
    k AS (SELECT *, false AS restored FROM c WHERE NOT (st <> 'success' AND registry_id IN (SELECT registry_id FROM u)) UNION ALL SELECT *, true FROM u)
    SELECT url, ord, restored FROM k QUALIFY row_number() OVER (PARTITION BY url ORDER BY restored, CASE st WHEN 'success' THEN 3 WHEN 'partial' THEN 2 ELSE 0 END DESC, ord) = 1""",
)
def fallback_overlay(spark, sf_dir):
    status = F.when(F.col("event_type").isin("click", "view"), "failed").when(F.col("value") > 20, "success").otherwise("partial")
    rows = events(spark, sf_dir).select(F.col("event_id").alias("ord"), F.concat("event_type", F.lit("/"), (F.col("user_id") % 50).cast("string")).alias("canonical_url"), F.col("event_type").alias("registry_id"), F.col("ts").alias("published_at"), status.alias("access_status"))
    current, old = rows.filter(F.col("ord") % 2 == 0), rows.filter(F.col("ord") % 2 != 0).withColumn("access_status", F.lit("success"))
    return dedupe.overlay_fallback(current, old, *[F.lit(w).cast("timestamp") for w in WINDOW]).select(F.col("canonical_url").alias("url"), "ord", "restored")


# ---------------------------------------------------------------- documents

TERMS = ["licensed", "rights reserved", "password", "example.com"]
EXCLUDED = ["!!", "***"]
SQL_TITLE_OF = "split_part(text, chr(10), 1)"


def titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col("source").alias("publisher"), "lang", "text", F.substring_index("text", "\n", 1).alias("title"))


def _sql_any(column: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{t}')" for t in terms) + ")"


@query("keyword_gate", f"SELECT doc_id, list_filter(['{"', '".join(TERMS)}'], lambda t: contains(lower(text), t)) AS terms FROM documents WHERE {_sql_any('text', TERMS)}")
def keyword_gate(spark, sf_dir):
    return titled(spark, sf_dir).withColumn("terms", text.matches(F.col("text"), TERMS)).filter(F.size("terms") > 0).select("doc_id", "terms")


@query("include_exclude", f"SELECT doc_id FROM documents WHERE {_sql_any('text', TERMS)} AND NOT {_sql_any('text', EXCLUDED)}")
def include_exclude(spark, sf_dir):
    return titled(spark, sf_dir).filter(predicates.passes_terms(F.col("text"), TERMS, EXCLUDED)).select("doc_id")


SQL_NORM = "trim(regexp_replace(replace(lower(title), '$', ''), '[^a-z0-9\\x{4e00}-\\x{9fff}]+', ' ', 'g'))"
SQL_TOKENS = "list_sort(list_distinct(list_filter(string_split(" + SQL_NORM + ", ' '), lambda w: length(w) > 1 AND w NOT IN ('" + "', '".join(text.STOP_WORDS) + "'))))"


@query("title_tokens", f"SELECT doc_id, {SQL_NORM} AS norm, array_to_string({SQL_TOKENS}, ' ') AS tokens FROM (SELECT doc_id, {SQL_TITLE_OF} AS title FROM documents)")
def title_tokens(spark, sf_dir):
    title = F.col("title")
    return titled(spark, sf_dir).select("doc_id", text.normalize_title(title).alias("norm"), F.array_join(F.array_sort(text.tokens(title)), " ").alias("tokens"))


#: Authored for the invented texts of the driver's tables.
RULES = scoring.Rules(
    routes={
        "route.rights": {"licensed": 8, "license": 6, "rights reserved": 7, "cc by": 5},
        "route.secrets": {"password": 9, "token =": 8, "akia": 7},
        "route.contact": {"example.com": 6, "+1 (": 5},
        "route.noise": {"!!": 5, "***": 4, " | ": 4},
        "route.prose": {"tionat": 3, "keit": 4, "mente": 4, "eaux": 4},
    },
    precedence=("route.secrets", "route.rights", "route.contact", "route.prose", "route.noise"),
    hard_terms=("!!",),
    soft_terms={"idiot": -3, "stupid": -3, "%%%": -2},
    boosts={"version 3": 2, "creative": 1, "token": 3},
    types={"type.legal": ("licensed", "rights", "public"), "type.private": ("password", "example.com", "akia"), "type.text": ("the ", " der ", " de ")},
    type_precedence=("type.private", "type.legal", "type.text"),
    source_boosts={"src0": {"type.legal": 1}, "src1": {"type.text": 2}},
    type_boosts={"type.private": 1},
    primary_source_types=("src0", "src2"),
    tags={"tech": {"tag.key": ("akia", "token"), "tag.mail": ("@",)}, "scene": {"scene.legal": ("rights", "licen")}},
    route_tags={"route.prose": "tag.prose", "route.secrets": "tag.key"},
    minimum_score=7,
)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.substr("text", F.length(F.substring_index("text", "\n", 1)) + 2)
    base = titled(spark, sf_dir).withColumn("excerpt", rest)
    return scoring.score_records(base, RULES, source_type="publisher").drop("text")


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


_RULE_ROWS = [(r, RULES.order().index(r), t, w) for r, ts in RULES.routes.items() for t, w in ts.items()]
_TYPE_ROWS = [(k, RULES.type_precedence.index(k), t) for k, ts in RULES.types.items() for t in ts]
SQL_SCORED = f"""
WITH base AS (SELECT doc_id, source AS publisher, {SQL_TITLE_OF} AS title, substr(text, length(split_part(text, chr(10), 1)) + 2) AS excerpt FROM documents),
rules(route, o, term, w) AS (VALUES {_values(_RULE_ROWS)}),
hits AS (SELECT doc_id, route, o, term, w, contains(lower(title), term) AS t, contains(lower(excerpt), term) AS e FROM base JOIN rules ON contains(lower(title), term) OR contains(lower(excerpt), term)),
per AS (SELECT doc_id, route, o, coalesce(max(w) FILTER (t), 0) AS best, coalesce(max(w) FILTER (t), 0) + least(3, greatest(0, count(*) FILTER (t) - 1)) + least(2, coalesce(max(w) FILTER (e), 0) // 4) AS points FROM hits GROUP BY 1, 2, 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN best > 0 THEN 0 ELSE 1 END, CASE WHEN best > 0 THEN -best ELSE -points END, o) AS r, count(*) OVER (PARTITION BY doc_id) AS n FROM per),
lead AS (SELECT doc_id, max(route) FILTER (r = 1) AS primary_route, max(points) FILTER (r = 1) AS points, max(n) AS n, string_agg(route, ',' ORDER BY r) FILTER (r BETWEEN 2 AND 4) AS secondary FROM ranked GROUP BY 1),
types(kind, o, term) AS (VALUES {_values(_TYPE_ROWS)}),
kinds AS (SELECT doc_id, kind, o, 2 * count(*) FILTER (contains(lower(title || ' ' || excerpt), term)) + CASE WHEN publisher = 'src0' AND kind = 'type.legal' THEN 1 WHEN publisher = 'src1' AND kind = 'type.text' THEN 2 ELSE 0 END AS s FROM base, types GROUP BY doc_id, kind, o, publisher),
kind AS (SELECT doc_id, kind, s FROM kinds QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, o) = 1),
ev AS (SELECT doc_id, publisher, title, lower(title || ' ' || excerpt) AS x FROM base)
SELECT ev.doc_id, CAST(coalesce(points, 0) + least(3, greatest(0, coalesce(n, 0) - 1))
  + greatest(CASE WHEN contains(x, 'version 3') THEN 2 ELSE 0 END, CASE WHEN contains(x, 'creative') THEN 1 ELSE 0 END, CASE WHEN contains(x, 'token') THEN 3 ELSE 0 END)
  + CASE WHEN contains(x, 'idiot') THEN -3 ELSE 0 END + CASE WHEN contains(x, 'stupid') THEN -3 ELSE 0 END + CASE WHEN contains(x, '%%%') THEN -2 ELSE 0 END
  + CASE WHEN kind = 'type.private' THEN 1 ELSE 0 END + CASE WHEN publisher IN ('src0', 'src2') THEN 2 ELSE 0 END AS INTEGER) AS score,
  primary_route, coalesce(secondary, '') AS secondary, kind, CAST(s AS INTEGER) AS kind_score, contains(lower(title), '!!') AS hard, x
FROM ev LEFT JOIN lead ON ev.doc_id = lead.doc_id JOIN kind ON ev.doc_id = kind.doc_id"""


@query("rule_scores", f"SELECT doc_id, score, primary_route, secondary FROM ({SQL_SCORED})")
def rule_scores(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "score", "primary_route", F.array_join("secondary_routes", ",").alias("secondary"))


@query("route_sums", f"SELECT doc_id, route, CAST(sum(w) AS INTEGER) AS score FROM documents JOIN (VALUES {_values(_RULE_ROWS)}) r(route, o, term, w) ON contains(lower(text), term) GROUP BY 1, 2")
def route_sums(spark, sf_dir):
    return titled(spark, sf_dir).select("doc_id", F.explode(scoring.route_scores(F.col("text"), RULES)).alias("route", "score"))


@query("rule_scores_join", f"SELECT doc_id, route, CAST(sum(w) AS INTEGER) AS score FROM documents JOIN (VALUES {_values(_RULE_ROWS)}) r(route, o, term, w) ON contains(lower(text), term) GROUP BY 1, 2")
def rule_scores_join(spark, sf_dir):
    """The same sums with the rules as a broadcast table: a self-check of the expression form."""
    rules = spark.createDataFrame(_RULE_ROWS, "route string, o int, term string, w int")
    low = titled(spark, sf_dir).select("doc_id", F.lower("text").alias("low"))
    return low.join(F.broadcast(rules), F.contains(F.col("low"), F.col("term"))).groupBy("doc_id", "route").agg(F.sum("w").cast("int").alias("score"))


@query("type_classify", f"SELECT doc_id, kind, kind_score FROM ({SQL_SCORED})")
def type_classify(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "kind", "kind_score")


@query(
    "tags",
    f"SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter([CASE WHEN contains(x, 'akia') OR contains(x, 'token') THEN 'tag.key' END, CASE WHEN contains(x, '@') THEN 'tag.mail' END, CASE primary_route WHEN 'route.prose' THEN 'tag.prose' WHEN 'route.secrets' THEN 'tag.key' END], lambda t: t IS NOT NULL))), ',') AS tech, CASE WHEN contains(x, 'rights') OR contains(x, 'licen') THEN 'scene.legal' ELSE 'scene.general' END AS scene FROM ({SQL_SCORED})",
)
def tags(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("t", scoring.atomic_tags(F.lower(F.concat_ws(" ", "title", "excerpt")), F.col("primary_route"), RULES))
    return s.select("doc_id", F.array_join("t.tech", ",").alias("tech"), F.array_join("t.scene", ",").alias("scene"))


SQL_DECISION = f"CASE WHEN hard THEN 'excluded' WHEN primary_route IS NULL THEN 'unrouted' WHEN score < {RULES.minimum_score} THEN 'below_threshold' ELSE 'eligible' END"


@query("exclusion_split", f"SELECT decision, count(*) AS n, CAST(sum(score) AS BIGINT) AS total FROM (SELECT {SQL_DECISION} AS decision, score FROM ({SQL_SCORED})) GROUP BY 1")
def exclusion_split(spark, sf_dir):
    return predicates.split_scored(scored(spark, sf_dir), RULES.minimum_score).groupBy("decision").agg(F.count("*").alias("n"), F.sum("score").alias("total"))


SQL_SOFT = "list_sort(list_filter([" + ", ".join(f"'{t}'" for t in RULES.soft_terms) + "], lambda t: contains(x, t)))"
SQL_OUTCOMES = f"""
WITH s AS (SELECT doc_id, hard, primary_route IS NULL AS unrouted, array_to_string({SQL_SOFT}, ',') AS soft FROM ({SQL_SCORED})),
o AS (
  SELECT doc_id, 'excluded' AS reason, '{RULES.hard_terms[0]}' AS terms FROM s WHERE hard
  UNION ALL SELECT doc_id, 'unrouted', '' FROM s WHERE NOT hard AND unrouted
  UNION ALL SELECT doc_id, 'demoted', soft FROM s WHERE NOT hard AND soft <> '')"""


@query("exclusions", f"{SQL_OUTCOMES} SELECT doc_id, reason, terms FROM o")
def exclusions(spark, sf_dir):
    """What is set aside or marked down of all documents, and by which terms."""
    return outcomes.exclusions(scored(spark, sf_dir), key="doc_id").select("doc_id", "reason", F.array_join("terms", ",").alias("terms"))


@query(
    "outcome_counts",
    f"{SQL_OUTCOMES} SELECT count(*) AS scored, (SELECT count(*) FROM o WHERE reason = 'excluded') AS excluded, (SELECT count(*) FROM o WHERE reason = 'demoted') AS demoted, (SELECT count(*) FROM o WHERE reason = 'unrouted') AS unrouted, count(*) FILTER (NOT hard AND NOT unrouted) AS routed FROM s",
)
def outcome_counts(spark, sf_dir):
    return outcomes.counts(scored(spark, sf_dir))


_SQL_SPOKE = " ".join(
    f"WHEN '{k}' THEN list_concat(list_transform(list_filter([{', '.join(repr(t) for t in sorted(ts))}], lambda t: contains(x, t)), lambda t: 'content:' || t), list_filter([{', '.join(repr('source_type:' + s) for s, b in RULES.source_boosts.items() if k in b)}]::VARCHAR[], lambda s: s = 'source_type:' || source))"
    for k, ts in RULES.types.items()
)


@query("type_signals", f"SELECT s.doc_id, s.kind, array_to_string(CASE s.kind {_SQL_SPOKE} END, ',') AS signals FROM ({SQL_SCORED}) s JOIN documents d ON s.doc_id = d.doc_id")
def type_signals(spark, sf_dir):
    """What spoke for the type that a document got."""
    low = F.lower(F.concat_ws(" ", "title", "excerpt"))
    spoke = scoring.type_signals(low, F.array("publisher"), F.col("kind"), RULES)
    return scored(spark, sf_dir).select("doc_id", "kind", F.array_join(spoke, ",").alias("signals"))


@query("focused_excerpt", None)
def focused_excerpt(spark, sf_dir):
    pages = F.split("text", "\n")
    return titled(spark, sf_dir).select("doc_id", records.focused_excerpt(pages, ["the", "rights reserved", "password"]).alias("excerpt"))


def distinct_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    norm = titled(spark, sf_dir).select("publisher", text.normalize_title(F.col("title")).alias("norm"), "doc_id")
    return norm.groupBy("publisher", "norm").agg(F.min("doc_id").alias("id")).withColumn("place", F.struct(F.col("id").alias("o")))


@query(
    "near_dup_pairs",
    f"""WITH t AS (SELECT source AS publisher, {SQL_NORM} AS norm, min(doc_id) AS id FROM (SELECT source, doc_id, {SQL_TITLE_OF} AS title FROM documents) GROUP BY 1, 2),
    k AS (SELECT publisher, id, list_distinct(list_filter(string_split(norm, ' '), lambda w: length(w) > 1 AND w NOT IN ('{"', '".join(text.STOP_WORDS)}'))) AS ws FROM t)
    SELECT a.id AS a, b.id AS b, len(list_intersect(a.ws, b.ws)) / len(list_distinct(list_concat(a.ws, b.ws))) AS similarity
    FROM k a JOIN k b ON a.publisher = b.publisher AND a.id < b.id WHERE len(a.ws) > 0 AND len(b.ws) > 0 AND len(list_intersect(a.ws, b.ws)) / len(list_distinct(list_concat(a.ws, b.ws))) >= 0.6""",
)
def near_dup_pairs(spark, sf_dir):
    return cluster.jaccard_pairs(distinct_titles(spark, sf_dir), 0.6)


@query("near_dup_groups", None)
def near_dup_groups(spark, sf_dir):
    """Every page with the one that leads its host's group of near titles; pages have titles as such, documents a first line."""
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    rows = table(spark, sf_dir, "pages").select(F.col("page_id").alias("ord"), urls.host(F.col("url")).alias("publisher"), title.alias("title"), F.pmod("page_id", F.lit(5)).cast("int").alias("score"))
    return cluster.group_titles(rows).select(F.col("ord").alias("page_id"), F.col("leader").alias("leader_id"))


@query(
    "cluster_rollup",
    "SELECT sha256(text) AS cluster, arg_min(doc_id, doc_id) AS first_doc, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS members, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM documents GROUP BY 1",
)
def cluster_rollup(spark, sf_dir):
    """Equal texts as one candidate, members in order."""
    docs = table(spark, sf_dir, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("cluster"), "doc_id", "source")
    return docs.groupBy("cluster").agg(
        F.min("doc_id").alias("first_doc"),
        F.count("*").alias("n"),
        F.array_join(F.array_sort(F.collect_list("doc_id")).cast("array<string>"), ",").alias("members"),
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select(F.col("doc_id").cast("string").alias("candidate_id"), "title", F.col("kind").alias("type"), F.col("primary_route").alias("route"), "score", F.lit("track.emerging").alias("track"))


QUOTA = select.Quota(
    target=25,
    minimum=12,
    minimum_score=7,
    type_minimums={"type.private": 8, "type.legal": 4, "type.text": 4},
    type_caps={"type.private": 12, "type.legal": 6, "type.text": 6},
    route_minimums={"route.contact": 3, "route.noise": 2, "route.rights": 3},
    route_caps={"route.secrets": 7, "route.rights": 7, "route.contact": 5, "route.noise": 5, "route.prose": 5},
)


@query("quota_select", None)
def quota_select(spark, sf_dir):
    return select.select_quota(candidates(spark, sf_dir), QUOTA).select("candidate_id", "status", "reason", "priority")


@query(
    "review_queue_topn",
    f"SELECT CAST(doc_id AS VARCHAR) AS candidate_id, score FROM (SELECT s.doc_id, s.score, s.primary_route, s.title FROM (SELECT x.*, {SQL_TITLE_OF.replace('text', 'd.text')} AS title FROM ({SQL_SCORED}) x JOIN documents d ON x.doc_id = d.doc_id) s JOIN labels l ON s.doc_id = l.doc_id WHERE s.score >= 6) ORDER BY score DESC, title, CAST(doc_id AS VARCHAR) LIMIT 10",
)
def review_queue_topn(spark, sf_dir):
    """The first ten labelled candidates of first priority: a top-k report."""
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("candidate_id")).distinct()
    rows = joins.watched(candidates(spark, sf_dir), known, "candidate_id").withColumn("priority", select.priority(F.lit("balanced"), F.col("track"), F.col("score"), 6))
    return select.review_queue(rows.withColumn("model_priority", F.lit(None).cast("string")).withColumn("relevance", F.lit(0)), most=10, type_minimums={}).select("candidate_id", "score")


@query("watchlist_semi", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def watchlist_semi(spark, sf_dir):
    return joins.watched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").filter("quality = 1"), "doc_id").select("doc_id", "source")


@query("watchlist_anti", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def watchlist_anti(spark, sf_dir):
    return joins.missing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source")


@query(
    "coverage_check",
    "SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'unexpected' ELSE 'duplicate' END AS problem FROM (SELECT DISTINCT doc_id FROM documents WHERE lang = 'en') d FULL JOIN (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR d.doc_id IS NULL OR n > 1",
)
def coverage_check(spark, sf_dir):
    return joins.coverage(table(spark, sf_dir, "documents").filter("lang = 'en'"), table(spark, sf_dir, "labels"), "doc_id")


@query(
    "recall_check",
    "SELECT b.item_id, EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = b.item_id) AS present, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = b.item_id AND l.quality = 1) AS selected FROM (SELECT DISTINCT item_id FROM benchmark) b",
)
def recall_check(spark, sf_dir):
    key = lambda df: df.select(F.col("doc_id").alias("item_id"))
    return summaries.recall(table(spark, sf_dir, "benchmark"), key(table(spark, sf_dir, "documents")), key(table(spark, sf_dir, "labels").filter("quality = 1")), "item_id")


@query("union_override", "SELECT doc_id, quality, toxic FROM labels UNION ALL SELECT doc_id, -1, -1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def union_override(spark, sf_dir):
    base = table(spark, sf_dir, "documents").select("doc_id", F.lit(-1).alias("quality"), F.lit(-1).alias("toxic"))
    return dedupe.union_override(base, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id")


# ---------------------------------------------------------------- conversations


@query(
    "sections_explode",
    "SELECT conv_id, CAST(count(*) AS BIGINT) AS turns, string_agg(role, '>' ORDER BY turn) AS roles, sha256(string_agg(text, chr(10) ORDER BY turn)) AS body_hash FROM conversations GROUP BY 1",
)
def sections_explode(spark, sf_dir):
    """Turns put together in order; a conversation is the bound of what is collected."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return turns.select("conv_id", F.size("t").cast("bigint").alias("turns"), F.array_join("t.role", ">").alias("roles"), F.sha2(F.array_join("t.text", "\n").cast("binary"), 256).alias("body_hash"))


@query(
    "sentences_explode",
    "SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS place, s[i] AS sentence FROM (SELECT conv_id, turn, string_split(text, '. ') AS s, unnest(range(1, len(string_split(text, '. ')) + 1)) AS i FROM conversations)",
)
def sentences_explode(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", r"\. ")).alias("place", "sentence"))


# ---------------------------------------------------------------- orders and lines


@query(
    "type_topk",
    "SELECT o_orderpriority, o_orderkey, rank FROM (SELECT o_orderpriority, o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders) WHERE rank <= 8",
)
def type_topk(spark, sf_dir):
    return summaries.top_per_group(table(spark, sf_dir, "orders"), "o_orderpriority", 8, F.col("o_totalprice").desc(), F.col("o_orderkey")).select("o_orderpriority", "o_orderkey", "rank")


@query(
    "sources_per_candidate",
    "SELECT o_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS parts, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1",
)
def sources_per_candidate(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("l"))
    joined = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select("o_orderkey", F.array_join(F.transform("l", lambda x: x["l_partkey"].cast("string")), ",").alias("parts"), F.size("l").cast("bigint").alias("n"))


@query(
    "candidate_members",
    "SELECT o_orderkey AS candidate_id, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS INTEGER) AS place, l_partkey AS source_id, p_name FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey",
)
def candidate_members(spark, sf_dir):
    """An ordered list of keys exploded, joined to what exists, order kept."""
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("source_ids"))
    orders = table(spark, sf_dir, "orders").join(lists, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderkey").alias("candidate_id"), "source_ids")
    return joins.members(orders, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("source_id"), "p_name")).select("candidate_id", "place", "source_id", "p_name")


@query("parallel_arrays", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE l_returnflag IN ('R', 'A')")
def parallel_arrays(spark, sf_dir):
    """Columns as parallel arrays and back to rows, then a list of allowed flags."""
    order = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_returnflag")))
    arrays = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(order.alias("x")).select("l_orderkey", F.col("x.l_linenumber").alias("a"), F.col("x.l_quantity").alias("b"), F.col("x.l_returnflag").alias("c"))
    rows = arrays.select("l_orderkey", F.inline(F.arrays_zip("a", "b", "c"))).toDF("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return rows.filter(predicates.allowed(F.col("l_returnflag"), ["R", "A"]))


@query(
    "integrity_violations",
    """SELECT 'order_customer' AS rule, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'line_order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'line_part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
    UNION ALL SELECT 'line_quantity', count(*) FROM lineitem WHERE NOT (l_quantity < 50)""",
)
def integrity_violations(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    count = lambda rule, df: df.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n")
    lines = t("lineitem")
    return (
        count("order_customer", joins.orphans(t("orders"), t("customer"), "o_custkey", "c_custkey"))
        .unionByName(count("line_order", joins.orphans(lines, t("orders"), "l_orderkey", "o_orderkey")))
        .unionByName(count("line_part", joins.orphans(lines, t("part"), "l_partkey", "p_partkey")))
        .unionByName(count("line_quantity", validate.row_rules(lines, "l_orderkey", {"line_quantity": F.col("l_quantity") < 50})))
    )


@query(
    "claim_ids",
    "SELECT 'clm_' || substr(trim(regexp_replace(lower(CAST(l_orderkey AS VARCHAR)), '[^a-z0-9]+', '_', 'g'), '_'), 1, 36) || '_' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS claim_id, l_partkey FROM lineitem",
)
def claim_ids(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(ids.claim_id(F.concat(F.lit("cand_"), F.col("l_orderkey").cast("string")), F.col("l_linenumber")).alias("claim_id"), "l_partkey")


@query(
    "ranked_stories",
    "SELECT 'story_' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 12) AS story_id, CAST(rank AS BIGINT) AS rank, CASE WHEN rank < 5 THEN 'deep_dive' ELSE 'brief' END AS article_type, CAST(greatest(70, 96 - 3 * rank) AS INTEGER) AS editorial_score FROM (SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 9 END, o_orderdate, CAST(o_orderkey AS VARCHAR)) - 1 AS rank FROM orders)",
)
def ranked_stories(spark, sf_dir):
    """A story of each order, in editorial order."""
    level = F.when(F.col("o_orderpriority") == "1-URGENT", "priority.p0").when(F.col("o_orderpriority") == "2-HIGH", "priority.p1").when(F.col("o_orderpriority") == "3-MEDIUM", "priority.p2").otherwise("none")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("event_id"), level.alias("priority"), F.col("o_orderdate").alias("event_at"), F.lit("order").alias("canonical_title"), F.lit("order").alias("fact_summary"), F.lit("none").alias("limitations"), F.array(F.lit("clm")).alias("claim_ids"))
    return editorial.stories(rows).select("story_id", "rank", "article_type", F.col("editorial_score").cast("int").alias("editorial_score"))


# ---------------------------------------------------------------- parsers, fed with bodies made of the tables


@query("sitemap_rows", "SELECT page_id AS registry_id, CAST(0 AS INTEGER) AS place, trim(url) AS url, CAST(DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER) AS VARCHAR) AS d FROM pages")
def sitemap_rows(spark, sf_dir):
    """Sitemaps of one url each, written and parsed again."""
    escaped = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 28).cast("int"))
    body = F.concat(F.lit("<urlset><url><loc>"), escaped, F.lit("</loc><lastmod>"), day.cast("string"), F.lit("</lastmod></url></urlset>"))
    got = landed.sitemap(table(spark, sf_dir, "pages").select(F.col("page_id").alias("registry_id"), body.alias("body")))
    return got.select("registry_id", "place", "url", F.to_date("modified_at").cast("string").alias("d"))


@query(
    "feed_rows",
    f"SELECT event_type AS registry_id, CAST(event_id AS VARCHAR) AS title, date_trunc('second', ts) AS published_at FROM events WHERE date_trunc('second', ts) BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'",
)
def feed_rows(spark, sf_dir):
    """A feed of one entry per event, written and parsed again, then cut to the window."""
    rows = events(spark, sf_dir)
    item = F.concat(F.lit("<rss><item><title>"), F.col("event_id").cast("string"), F.lit("</title><link>https://e.org/"), F.col("event_id").cast("string"), F.lit("</link><pubDate>"), F.date_format("ts", "d MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate></item></rss>"))
    pages = rows.select(F.col("event_type").alias("registry_id"), F.lit("https://e.org/feed").alias("url"), item.alias("body"))
    got = landed.accepted_entries(landed.feed_entries(pages), *[F.lit(w).cast("timestamp") for w in WINDOW], [])
    return got.select("registry_id", "title", "published_at")


@query(
    "filing_rows",
    "SELECT CAST(o_custkey AS VARCHAR) AS cik, o_orderpriority AS form, CAST(o_orderkey AS VARCHAR) AS title_key, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def filing_rows(spark, sf_dir):
    """Orders of a customer as parallel arrays in JSON, and back to rows of the wanted forms."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderdate", "o_orderpriority"))).alias("o"))
    text_of = lambda f: F.transform("o", f)
    key = text_of(lambda x: x["o_orderkey"].cast("string"))
    recent = F.struct(key.alias("accessionNumber"), text_of(lambda x: F.date_format(x["o_orderdate"], "yyyy-MM-dd")).alias("filingDate"), text_of(lambda x: F.lit("")).alias("acceptanceDateTime"), text_of(lambda x: x["o_orderpriority"]).alias("form"), key.alias("primaryDocument"), key.alias("primaryDocDescription"))
    body = F.to_json(F.struct(F.struct(recent.alias("recent")).alias("filings")))
    got = landed.filings(orders.select(F.col("o_custkey").cast("string").alias("cik"), body.alias("body")), ["1-URGENT", "2-HIGH"])
    return got.select("cik", "form", F.regexp_extract("title", r"(\d+)$", 1).alias("title_key"), F.to_date("published_at").cast("string").alias("d"))


@query(
    "inbox_rows",
    f"SELECT event_id FROM events WHERE value > 1 AND (event_type = 'error' OR ts BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}')",
)
def inbox_rows(spark, sf_dir):
    """Pushed rows: enabled, and discovered in the window or at an unknown time."""
    rows = events(spark, sf_dir).select("event_id", F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("url"), (F.col("value") > 1).alias("enabled"), F.when(F.col("event_type") != "error", F.col("ts")).alias("discovered_at"))
    return landed.inbox(rows, *[F.lit(w).cast("timestamp") for w in WINDOW]).select("event_id")


@query(
    "rotating_accounts",
    "SELECT s_suppkey, s_name FROM (SELECT *, row_number() OVER (ORDER BY CASE WHEN s_nationkey < 5 THEN 0 WHEN s_nationkey < 12 THEN 1 ELSE 2 END, s_name) - 1 AS i, count(*) OVER () AS n FROM supplier) WHERE ((i - (738907 + 4) % n) % n + n) % n < 4",
)
def rotating_accounts(spark, sf_dir):
    """Four accounts of a circular list, from a start that moves with the week and its half."""
    level = F.when(F.col("s_nationkey") < 5, "P0").when(F.col("s_nationkey") < 12, "P1").otherwise("P2")
    accounts = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("account_name"), level.alias("priority"))
    return landed.rotating_subset(accounts, dt.date(2024, 1, 25), 4).select("s_suppkey", F.col("account_name").alias("s_name"))


@query(
    "best_search_match",
    "SELECT c_mktsegment AS name, CAST(c_custkey AS VARCHAR) AS id FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey DESC, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END DESC, CAST(c_custkey % 3 AS INTEGER) DESC, CAST(c_custkey AS VARCHAR)) = 1",
)
def best_search_match(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("name"), F.col("c_mktsegment").alias("nickname"), F.col("c_custkey").cast("string").alias("id"), F.col("c_nationkey").alias("verify_status"), F.when(F.col("c_acctbal") > 0, "alias").alias("alias"), (F.col("c_custkey") % 3).cast("int").alias("service_type"))
    return landed.exact_match(rows).select("name", "id")


@query(
    "excerpt_cut",
    "SELECT doc_id, length(text) AS n_text, CAST(CASE WHEN source = 'src0' THEN least(length(text), 6000) ELSE least(length(text), 1800) END AS INTEGER) AS n_excerpt, sha256(CASE WHEN source = 'src0' THEN substr(text, 1, 6000) ELSE substr(text, 1, 1800) END) AS excerpt_hash FROM documents",
)
def excerpt_cut(spark, sf_dir):
    kind = F.when(F.col("source") == "src0", "financial_report").otherwise("other")
    cut = text.excerpt(kind, F.lit(""), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("bigint").alias("n_text"), F.length(cut).alias("n_excerpt"), F.sha2(cut.cast("binary"), 256).alias("excerpt_hash"))


QUESTIONS = {
    "fixed_set": ["What changed in the watched source?"],
    "by_source": [(("src1",), ["Which table states the figures?", "What is inferred?"]), (("src2", "src3"), ["Is it available now?"])],
    "common": ["What is new?", "Where is it stated?"],
    "by_route": {"route.prose": "Does it hold outside this text?", "route.noise": "Is there a text at all?"},
}


@query(
    "verification_questions",
    f"SELECT s.doc_id, CASE WHEN d.source = 'src0' THEN 'What changed in the watched source?' WHEN d.source = 'src1' THEN 'Which table states the figures?|What is inferred?' WHEN d.source IN ('src2', 'src3') THEN 'Is it available now?' ELSE 'What is new?|Where is it stated?' || CASE s.primary_route WHEN 'route.prose' THEN '|Does it hold outside this text?' WHEN 'route.noise' THEN '|Is there a text at all?' ELSE '' END END AS questions FROM ({SQL_SCORED}) s JOIN documents d ON s.doc_id = d.doc_id",
)
def verification_questions(spark, sf_dir):
    asked = select.questions(F.col("publisher") == "src0", F.array("publisher"), F.col("primary_route"), **QUESTIONS)
    return scored(spark, sf_dir).select("doc_id", F.array_join(asked, "|").alias("questions"))


SQL_ROLLED = """
WITH o AS (SELECT o_orderkey AS ord, o_custkey AS leader, CAST(floor(o_totalprice / 10000) AS INTEGER) AS score, o_orderpriority || ' ' || o_orderstatus AS title, o_orderdate AS day FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY leader ORDER BY score DESC, title, ord) AS r FROM o),
c AS (SELECT leader, max(title) FILTER (r = 1) AS title, max(score) FILTER (r = 1) AS score, max(day) FILTER (r = 1) AS lead_at, min(day) AS first_at, string_agg('s' || ord, ',' ORDER BY r) AS source_ids, CAST(count(*) AS INTEGER) AS source_count FROM r GROUP BY 1)
SELECT 'cand_' || substr(sha256(title || strftime(lead_at, '%Y-%m-%dT%H:%M:%SZ')), 1, 16) AS candidate_id, title AS canonical_title, score, source_ids, source_count, CAST(CAST(first_at AS DATE) AS VARCHAR) AS first_day,
  CASE WHEN source_count > 1 THEN 'near_title' ELSE 'single' END AS method FROM c"""


def member_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as the members of one group."""
    none = F.array().cast("array<string>")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ord"),
        F.col("o_custkey").alias("leader"),
        F.floor(F.col("o_totalprice") / 10000).cast("int").alias("score"),
        F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("title"),
        F.lit("orders").alias("source_name"),
        F.col("o_orderpriority").alias("primary_route"),
        none.alias("secondary_routes"),
        F.concat(F.lit("s"), F.col("o_orderkey").cast("string")).alias("source_id"),
        F.concat(F.lit("https://o.org/"), F.col("o_orderkey").cast("string")).alias("canonical_url"),
        F.col("o_orderdate").cast("timestamp").alias("published_at"),
        none.alias("signals"),
    )


def rolled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.roll_up(member_orders(spark, sf_dir))


SQL_ROLLED_FIXED = """
WITH o AS (SELECT o_orderkey AS ord, o_custkey AS leader, o_custkey = 7 AS ours, CAST(floor(o_totalprice / 10000) AS INTEGER) AS score, o_orderpriority || ' ' || o_orderstatus AS title, o_orderdate AS day, o_orderpriority AS route, 'o:' || lower(o_orderstatus) AS negative FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY leader ORDER BY CASE WHEN ours THEN day END, CASE WHEN NOT ours THEN -score END, title, ord) AS r, row_number() OVER (PARTITION BY leader ORDER BY -score, CASE WHEN ours THEN day END, title, ord) AS b FROM o),
c AS (SELECT leader, bool_or(ours) AS ours, CASE WHEN bool_or(ours) THEN 'The watched customer' ELSE max(title) FILTER (b = 1) END AS title, max(route) FILTER (b = 1) AS primary_route, max(score) FILTER (b = 1) AS score, max(day) FILTER (r = 1) AS lead_at, string_agg('s' || ord, ',' ORDER BY r) AS source_ids, CAST(count(*) AS INTEGER) AS source_count, string_agg(DISTINCT negative, ',' ORDER BY negative) AS negative_signals FROM r GROUP BY 1)
SELECT 'cand_' || substr(sha256(title || strftime(lead_at, '%Y-%m-%dT%H:%M:%SZ')), 1, 16) AS candidate_id, title AS canonical_title, primary_route, score + CASE WHEN ours THEN 3 ELSE 0 END AS score, CASE WHEN ours THEN 'track.fixed' ELSE 'track.emerging' END AS track, source_ids, negative_signals,
  CASE WHEN ours THEN 'fixed_cluster' WHEN source_count > 1 THEN 'near_title' ELSE 'single' END AS method FROM c"""


@query("fixed_rollup", SQL_ROLLED_FIXED)
def fixed_rollup(spark, sf_dir):
    """Orders of one watched customer as one candidate of its own, the others by customer; negative signals kept."""
    rows = member_orders(spark, sf_dir).withColumn("source_name", F.concat(F.lit("customer "), F.col("leader").cast("string")))
    rows = rows.withColumn("negative", F.array(F.concat(F.lit("o:"), F.lower(F.substring_index("title", " ", -1)))))
    rolled = cluster.roll_up(rows, fixed="customer 7", fixed_title="The watched customer")
    return rolled.select("candidate_id", "canonical_title", "primary_route", "score", "track", F.array_join("source_ids", ",").alias("source_ids"), F.array_join("negative_signals", ",").alias("negative_signals"), "method")


SQL_SHORT = """
WITH o AS (SELECT CAST(CASE WHEN o_orderkey % 101 = 0 THEN o_custkey ELSE -o_orderkey END AS VARCHAR) AS candidate_id, o_orderkey AS k, o_orderpriority AS type, 'r' || (o_custkey % 20) AS route, o_custkey = 7 AS ours, o_orderstatus = 'F' AS chosen FROM orders),
s AS (SELECT * FROM o WHERE chosen), f AS (SELECT * FROM o WHERE NOT chosen),
want(route, least) AS (VALUES ('r1', 1), ('r2', 1000000000), ('r99', 3)),
x AS (SELECT count(*) AS n FROM s WHERE ours)
SELECT 'size' AS rule, CAST(count(*) AS VARCHAR) AS key FROM s HAVING count(*) NOT BETWEEN 12 AND 30
UNION ALL SELECT 'duplicate_id', candidate_id FROM s GROUP BY candidate_id HAVING count(*) > 1
UNION ALL SELECT 'reason', candidate_id FROM s WHERE k % 97 = 0
UNION ALL SELECT 'questions', candidate_id FROM s WHERE k % 89 = 0
UNION ALL SELECT 'status', candidate_id FROM s WHERE k % 83 = 0
UNION ALL SELECT 'known_type', candidate_id FROM s WHERE type = '5-LOW'
UNION ALL SELECT 'type_cap', type FROM s WHERE type = '1-URGENT' GROUP BY type HAVING count(*) > 10
UNION ALL SELECT DISTINCT 'type_retained', type FROM f WHERE type NOT IN (SELECT type FROM s)
UNION ALL SELECT 'route_minimum', route FROM want w WHERE (SELECT count(*) FROM s WHERE s.route = w.route) < least(w.least, (SELECT count(*) FROM o WHERE o.route = w.route))
UNION ALL SELECT 'fixed_cluster', CAST(n AS VARCHAR) FROM x WHERE n <> 1 OR (SELECT bool_or(k % 2 = 0) FROM s WHERE ours)"""


@query("shortlist_violations", SQL_SHORT)
def shortlist_violations(spark, sf_dir):
    """Rules of a shortlist over all orders, each broken somewhere; finished orders are the chosen."""
    key, ours = F.col("o_orderkey"), F.col("o_custkey") == 7
    rows = table(spark, sf_dir, "orders").select(
        F.when(key % 101 == 0, F.col("o_custkey")).otherwise(-key).cast("string").alias("candidate_id"),
        F.when(key % 97 != 0, "balanced").alias("reason"),
        F.when(key % 83 == 0, "verified").otherwise("selected").alias("status"),
        F.when(key % 89 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("What is new?"))).alias("verification_questions"),
        F.col("o_orderpriority").alias("type"),
        F.concat(F.lit("r"), (F.col("o_custkey") % 20).cast("string")).alias("route"),
        F.when(ours, "The watched customer").otherwise("other").alias("canonical_title"),
        F.when(key % 2 == 0, "near_title").otherwise("fixed_cluster").alias("method"),
        F.lit(3).alias("source_count"),
        "o_orderstatus",
    )
    chosen = F.col("o_orderstatus") == "F"
    kinds = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
    return validate.shortlist(rows.filter(chosen), rows.filter(~chosen), types=kinds, type_caps={"1-URGENT": 10}, route_minimums={"r1": 1, "r2": 1_000_000_000, "r99": 3}, fixed_title="The watched customer", collapsed=2)


@query("candidate_rollup", SQL_ROLLED)
def candidate_rollup(spark, sf_dir):
    rolled = rolled_orders(spark, sf_dir)
    return rolled.select("candidate_id", "canonical_title", "score", F.array_join("source_ids", ",").alias("source_ids"), "source_count", F.to_date("published_at").cast("string").alias("first_day"), "method")


@query("processing_summary", f"SELECT method, count(*) AS candidates, CAST(sum(source_count) AS BIGINT) AS members, CAST(sum(source_count - 1) AS BIGINT) AS collapsed FROM ({SQL_ROLLED}) GROUP BY 1")
def processing_summary(spark, sf_dir):
    return summaries.processing_summary(rolled_orders(spark, sf_dir))
