"""Queries of a run's later steps and of the page parsers, with the DuckDB SQL that checks them.

An order with lines stands for a reviewed candidate and its lines for the claims; parsers
read pages made of a customer's orders.  All run over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltworks.functions import records
from siltworks.operators import dedupe, editorial, enrich, joins, predicates, review, select, summaries, validate
from siltworks.plans import runs
from siltworks.plans.catalogue import events, query, table
from siltworks.sources import articles, landed

text_of = lambda c: F.col(c).cast("string")
SINCE, UNTIL = "1995-01-01 00:00:00", "1996-12-31 00:00:00"


def span() -> list:
    return [F.lit(d).cast("timestamp") for d in (SINCE, UNTIL)]


# ---------------------------------------------------------------- review, events, issue

SQL_LINES = """
l AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_returnflag) AS i, l_partkey AS part, l_returnflag AS flag FROM lineitem),
per AS (SELECT k, count(*) AS n, bool_or(flag = 'R') AS bare, string_agg('part ' || part, '; ' ORDER BY i) AS said, string_agg('clm_' || k || '_' || lpad(CAST(i AS VARCHAR), 2, '0'), ',' ORDER BY i) AS claim_ids FROM l GROUP BY 1),
r AS (SELECT o.*, per.*, 'cand_' || k AS candidate_id, 's' || k AS source_id, CASE WHEN o_totalprice <= 300000 THEN o_orderpriority || ' co' END AS entity FROM orders o JOIN per ON o_orderkey = k)"""


def ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that have lines, with these in order as ``l``."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))).alias("l"))
    return table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))


def reviews(spark: SparkSession, sf_dir: str, event: str = "o_orderkey") -> DataFrame:
    """Orders with lines as reviews; some break each rule of the gate."""
    level = F.col("o_orderpriority")
    claim = lambda x: F.struct(F.concat(F.lit("part "), x["l_partkey"].cast("string"), F.lit(". ")).alias("text"), x["l_returnflag"].alias("kind"), F.when(x["l_returnflag"] == "R", "").otherwise("line").alias("locator"), F.lit(None).cast("string").alias("quote_excerpt"))
    made = F.struct(
        F.concat(F.lit("evt_"), text_of(event)).alias("event_id"),
        level.alias("canonical_title"),
        F.col("o_orderstatus").alias("event_type"),
        level.alias("primary_route"),
        F.when(F.col("o_totalprice") > 200000, "priority.p0").otherwise("priority.p1").alias("priority"),
        F.lit("low").alias("confidence"),
        F.when(F.col("o_totalprice") <= 300000, F.concat(level, F.lit(" co"))).alias("entity_name"),
        F.array().cast("array<string>").alias("tags"),
    )
    return ordered_lines(spark, sf_dir).select(
        F.concat(F.lit("cand_"), text_of("o_orderkey")).alias("candidate_id"),
        F.concat(F.lit("s"), text_of("o_orderkey")).alias("source_id"),
        level.alias("title"),
        F.lit("https://o.org/").alias("url"),
        F.col("o_orderdate").cast("timestamp").alias("published_at"),
        F.when(level == "4-NOT SPECIFIED", "pending").otherwise("verified_primary").alias("verification_status"),
        F.transform("l", claim).alias("claims"),
        F.when((level != "3-MEDIUM") | (F.col("o_orderstatus") != "F"), "one table").alias("limitation"),
        F.when(level == "1-URGENT", "include").when(level == "5-LOW", "reject").otherwise("watch").alias("decision"),
        F.when(level == "2-HIGH", " ").otherwise(level).alias("decision_reason"),
        made.alias("event"),
    )


def reviewed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lit("s"), text_of("o_orderkey"))
    listed = F.when(F.col("o_orderstatus") == "O", F.array(F.lit("a"), key)).otherwise(F.array(F.lit("a")))
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("cand_"), text_of("o_orderkey")).alias("candidate_id"), listed.alias("source_ids"), F.lit("track.emerging").alias("track"), "o_orderstatus")


@query("review_claims", f"WITH {SQL_LINES} SELECT 'clm_' || k || '_' || lpad(CAST(i AS VARCHAR), 2, '0') AS claim_id, 'cand_' || k AS candidate_id, 's' || k AS source_id, 'part ' || part || '. ' AS claim_text, flag AS claim_kind, CASE WHEN flag = 'R' THEN '' ELSE 'line' END AS source_locator FROM l WHERE k IN (SELECT o_orderkey FROM orders)")
def review_claims(spark, sf_dir):
    return review.claims(reviews(spark, sf_dir)).drop("quote_excerpt")


@query(
    "review_events",
    f"""WITH {SQL_LINES} SELECT 'evt_' || k AS event_id, o_orderstatus AS event_type, CASE WHEN o_orderstatus = 'O' THEN 'a,' || source_id ELSE source_id || ',a' END AS source_ids, CAST(2 AS INTEGER) AS source_count, claim_ids, said || '.' AS fact_summary,
    concat_ws('|', trim(regexp_replace(lower(entity), '[^a-z0-9]+', '_', 'g'), '_'), o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS dedupe_key FROM r WHERE o_orderpriority = '1-URGENT'""",
)
def review_events(spark, sf_dir):
    made = review.events(reviews(spark, sf_dir), reviewed_candidates(spark, sf_dir))
    return made.select("event_id", "event_type", F.array_join("source_ids", ",").alias("source_ids"), "source_count", F.array_join("claim_ids", ",").alias("claim_ids"), "fact_summary", "dedupe_key")


@query(
    "review_gate",
    f"""WITH {SQL_LINES}, i AS (SELECT * FROM r WHERE o_orderpriority = '1-URGENT')
    SELECT 'approved' AS rule, CAST(NULL AS VARCHAR) AS key UNION ALL SELECT 'verifier', NULL
    UNION ALL SELECT 'unknown_candidate', candidate_id FROM r WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'missing_queued', 'cand_' || o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT k FROM per)
    UNION ALL SELECT 'source_unverified', candidate_id FROM r WHERE o_orderpriority = '4-NOT SPECIFIED'
    UNION ALL SELECT 'decision', candidate_id FROM r WHERE o_orderpriority = '5-LOW'
    UNION ALL SELECT 'decision_reason', candidate_id FROM r WHERE o_orderpriority = '2-HIGH'
    UNION ALL SELECT 'limitation', candidate_id FROM r WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F'
    UNION ALL SELECT 'claim_fields', candidate_id FROM r WHERE bare
    UNION ALL SELECT 'event_fields', candidate_id FROM i WHERE entity IS NULL OR o_custkey IS NULL
    UNION ALL SELECT 'duplicate_event', 'evt_' || o_custkey FROM i WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1
    UNION ALL SELECT 'event_count', CAST(count(*) AS VARCHAR) FROM i HAVING count(*) NOT BETWEEN 5 AND 10""",
)
def review_gate(spark, sf_dir):
    """Every broken rule of a review that nobody approved; some candidates are unknown, some queued ones not reviewed."""
    known = reviewed_candidates(spark, sf_dir)
    return review.violations(reviews(spark, sf_dir, "o_custkey"), known.filter("o_orderstatus <> 'P'"), known, status="pending")


@query("review_decisions", f"WITH {SQL_LINES} SELECT count(*) AS reviewed, count(*) FILTER (o_orderpriority = '1-URGENT') AS include, count(*) FILTER (o_orderpriority IN ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')) AS watch, CAST(0 AS BIGINT) AS exclude FROM r")
def review_decisions(spark, sf_dir):
    return summaries.decisions(reviews(spark, sf_dir))


@query("review_template", "SELECT 'cand_' || o_orderkey AS candidate_id, 's' || o_orderkey AS source_id, 'https://o.org/' || o_orderkey AS url, 'pending' AS verification_status, 'pending' AS decision, CASE WHEN o_orderstatus = 'F' THEN 'Is it final?|Who ordered?' ELSE 'Is it final?' END AS questions FROM orders")
def review_template(spark, sf_dir):
    """A pending review per candidate; the model's questions follow the rules' without repeats."""
    orders = table(spark, sf_dir, "orders")
    key = F.concat(F.lit("s"), text_of("o_orderkey"))
    asked = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("Is it final?"), F.lit("Who ordered?")))
    queue = orders.select(F.concat(F.lit("cand_"), text_of("o_orderkey")).alias("candidate_id"), key.alias("primary_source_id"), F.col("o_orderpriority").alias("canonical_title"), F.col("o_orderdate").alias("published_at"), F.array(F.lit("Is it final?")).alias("verification_questions"), asked.alias("model_questions"))
    made = review.template(queue, orders.select(key.alias("source_id"), F.concat(F.lit("https://o.org/"), text_of("o_orderkey")).alias("canonical_url")))
    return made.select("candidate_id", "source_id", "url", "verification_status", "decision", F.array_join("verification_questions", "|").alias("questions"))


@query("review_selection", "SELECT r_name AS candidate_id, CASE WHEN r_name IN ('AFRICA', 'ASIA') THEN 'include' ELSE 'watch' END AS decision FROM region")
def review_selection(spark, sf_dir):
    rows = table(spark, sf_dir, "region").select(F.col("r_name").alias("candidate_id"), F.lit("pending").alias("decision"))
    return review.apply_selection(rows, ["AFRICA", "ASIA"], ["AMERICA", "EUROPE", "MIDDLE EAST"])


@query("review_carry_over", "SELECT d.doc_id, coalesce(CASE WHEN d.lang = 'en' THEN 7 END, l.quality, -1) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def review_carry_over(spark, sf_dir):
    """The current value, or that of the earlier review."""
    current = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", 7).alias("quality"))
    return joins.carry_over(current, table(spark, sf_dir, "labels"), "doc_id", "quality").fillna(-1, ["quality"])


@query("event_order", "SELECT CAST(o_orderkey AS VARCHAR) AS event_id, CAST(row_number() OVER o AS BIGINT) AS rank, row_number() OVER o <= 5 AS is_top FROM orders WINDOW o AS (ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 9 END, o_orderdate, CAST(o_orderkey AS VARCHAR))")
def event_order(spark, sf_dir):
    level = F.when(F.col("o_orderpriority") == "1-URGENT", "priority.p0").when(F.col("o_orderpriority") == "2-HIGH", "priority.p1").otherwise("other")
    return review.ranked_events(table(spark, sf_dir, "orders").select(text_of("o_orderkey").alias("event_id"), level.alias("priority"), F.col("o_orderdate").alias("event_at"))).select("event_id", "rank", "is_top")


@query("event_publishers", "SELECT l_orderkey AS event_id, count(DISTINCT s_nationkey) AS publishers FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1")
def event_publishers(spark, sf_dir):
    """Suppliers are the sources of an order, their nations the publishers."""
    found = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("event_id")).agg(F.collect_set("l_suppkey").alias("source_ids"))
    return review.independent_publishers(found, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source_id"), F.col("s_nationkey").alias("publisher")))


@query(
    "story_bundle",
    f"""WITH {SQL_LINES}, e AS (SELECT *, 'evt_' || k AS event_id, row_number() OVER (ORDER BY CASE WHEN o_totalprice > 200000 THEN 0 ELSE 1 END, o_orderdate, 'evt_' || k) - 1 AS rank FROM r WHERE o_orderpriority = '1-URGENT')
    SELECT 'story_' || substr(sha256(event_id), 1, 12) AS story_id, event_id, CASE WHEN rank < 5 THEN 'deep_dive' ELSE 'brief' END AS article_type, said || '.' AS fact_summary, claim_ids, n AS n_claims, candidate_id, o_orderpriority AS decision_reason FROM e""",
)
def story_bundle(spark, sf_dir):
    """Stories with their event, review and claims."""
    told = reviews(spark, sf_dir)
    found = review.events(told, reviewed_candidates(spark, sf_dir))
    made = editorial.bundle(editorial.stories(found), found, review.claims(told), told)
    return made.select("story_id", F.col("event.event_id").alias("event_id"), "article_type", F.col("event.fact_summary").alias("fact_summary"), F.array_join("claims.claim_id", ",").alias("claim_ids"), F.size("claims").cast("bigint").alias("n_claims"), F.col("review.candidate_id").alias("candidate_id"), F.col("review.decision_reason").alias("decision_reason"))


@query(
    "issue_violations",
    f"""WITH {SQL_LINES}, e AS (SELECT * FROM r WHERE o_orderpriority = '1-URGENT')
    SELECT 'size' AS rule, CAST(count(*) AS VARCHAR) AS key FROM e HAVING count(*) NOT BETWEEN 5 AND 10
    UNION ALL SELECT 'unknown_claim', 'story_' || substr(sha256('evt_' || l.k), 1, 12) FROM l JOIN e ON l.k = e.k WHERE flag = 'R'
    UNION ALL SELECT 'trends', CAST(count(DISTINCT o_orderpriority) AS VARCHAR) FROM e HAVING count(DISTINCT o_orderpriority) NOT BETWEEN 1 AND 4""",
)
def issue_violations(spark, sf_dir):
    """The issue's rules; claims of returned lines are missing."""
    told = reviews(spark, sf_dir)
    found = review.events(told, reviewed_candidates(spark, sf_dir))
    return validate.issue(editorial.stories(found), found, review.claims(told).filter("claim_kind <> 'R'"), editorial.timeline(found, category="event_type"), editorial.trends(found))


@query(
    "verified_violations",
    f"""WITH {SQL_LINES}, e AS (SELECT * FROM r WHERE o_orderpriority = '1-URGENT')
    SELECT 'size' AS rule, CAST(count(*) AS VARCHAR) AS key FROM e HAVING count(*) NOT BETWEEN 5 AND 10
    UNION ALL SELECT 'unknown_claim', 'evt_' || l.k FROM l JOIN e ON l.k = e.k WHERE flag = 'R'
    UNION ALL SELECT 'unknown_source', 'evt_' || k FROM e WHERE o_orderstatus <> 'O'""",
)
def verified_violations(spark, sf_dir):
    told, known = reviews(spark, sf_dir), reviewed_candidates(spark, sf_dir)
    sources = known.filter("o_orderstatus = 'O'").select(F.explode("source_ids").alias("source_id"))
    return validate.verified(review.events(told, known), review.claims(told).filter("claim_kind <> 'R'"), sources)


@query("issue_row", "SELECT 'issue_' || CAST(isoyear(max(CAST(ts AS DATE))) AS VARCHAR) || '_w' || lpad(CAST(weekofyear(max(CAST(ts AS DATE))) AS VARCHAR), 2, '0') AS issue_id, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last_day, count(*) AS events FROM events")
def issue_row(spark, sf_dir):
    return editorial.issue(events(spark, sf_dir).withColumn("event_at", F.col("ts"))).withColumn("last_day", text_of("last_day"))


@query(
    "day_members",
    "WITH s AS (SELECT greatest(max(CAST(ts AS DATE)), min(CAST(ts AS DATE)) + 6) AS e FROM events) SELECT CAST(least(e, greatest(e - 6, CAST(ts AS DATE))) AS VARCHAR) AS day, CAST(event_id AS VARCHAR) AS event_id, 'story_' || substr(sha256(CAST(event_id AS VARCHAR)), 1, 12) AS story_id FROM events, s",
)
def day_members(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("event_id", text_of("event_id"))
    return editorial.day_members(rows, editorial.timeline(rows, at="ts", category="event_type"), at="ts").withColumn("day", text_of("day"))


@query("trend_members", "SELECT 'trend_' || substr(sha256(event_type), 1, 12) AS trend_id, event_id FROM events WHERE event_type IN (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 4)")
def trend_members(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("name", text_of("user_id"))
    return editorial.trend_members(rows, editorial.trends(rows, route="event_type", name="name"), route="event_type")


# ---------------------------------------------------------------- run, registry, enrichment


@query("enabled_sources", "SELECT s_suppkey FROM supplier WHERE s_acctbal > 0")
def enabled_sources(spark, sf_dir):
    return predicates.enabled_sources(table(spark, sf_dir, "supplier").withColumn("enabled", F.col("s_acctbal") > 0)).select("s_suppkey")


@query("url_pattern", "SELECT page_id FROM pages WHERE regexp_matches(url, '[05]([/?#.]|$)')")
def url_pattern(spark, sf_dir):
    return table(spark, sf_dir, "pages").filter(predicates.url_allowed(F.col("url"), r"[05]([/?#.]|$)")).select("page_id")


@query("keyword_groups", "SELECT s_suppkey, coalesce(k, '') AS keywords FROM supplier LEFT JOIN (SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS k FROM customer GROUP BY 1) ON s_nationkey = c_nationkey")
def keyword_groups(spark, sf_dir):
    groups = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("keyword_group"), F.col("c_mktsegment").alias("term"))
    return joins.with_keywords(table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "keyword_group"), groups).select("s_suppkey", F.array_join("keywords", ",").alias("keywords"))


@query(
    "collection_checks",
    """WITH e AS (SELECT *, event_type <> 'click' AS known, value > 10 AS got FROM events)
    SELECT event_type AS registry_id, CASE WHEN count(*) FILTER (known AND got) > 0 THEN 'success' ELSE 'failed' END AS status, count(*) FILTER (known AND got) AS accepted FROM e GROUP BY 1
    UNION ALL SELECT r_name, 'failed', 0 FROM region""",
)
def collection_checks(spark, sf_dir):
    """A landed page per event; one kind has no adapter, small values were not fetched, regions are sources nobody fetched."""
    rows = events(spark, sf_dir)
    adapter = F.when(F.col("registry_id") == "click", "odd").otherwise("page")
    named = rows.select(F.col("event_type").alias("registry_id")).distinct().unionByName(table(spark, sf_dir, "region").select(F.col("r_name").alias("registry_id")))
    registry = named.select("registry_id", adapter.alias("adapter"), F.lit(True).alias("enabled"), F.col("registry_id").alias("source_name"), F.lit("news").alias("source_type"), F.col("registry_id").alias("publisher"), F.lit("en").alias("language"))
    pages = rows.select(F.col("event_type").alias("registry_id"), F.concat(F.lit("https://e.org/"), text_of("event_id")).alias("url"), F.when(F.col("value") > 10, "body").alias("body"), F.lit(None).cast("string").alias("reason"))
    _, checks = runs.collect(pages, registry, {"page": lambda mine: mine.select("registry_id", "url", F.col("body").alias("raw_title"))}, "2024-02-01 00:00:00")
    return checks.select("registry_id", "status", "accepted")


@query("set_equality", "SELECT NOT EXISTS (SELECT s_nationkey FROM supplier EXCEPT SELECT n_nationkey FROM nation) AND NOT EXISTS (SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier) AS same")
def set_equality(spark, sf_dir):
    have = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("key")).distinct()
    return spark.createDataFrame([(joins.same_set(have, table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"))),)], "same boolean")


@query("ordered_union", "WITH l AS (SELECT l_orderkey AS k, CAST(l_suppkey AS VARCHAR) AS s, CAST(l_partkey AS VARCHAR) AS p, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_suppkey AS VARCHAR), CAST(l_partkey AS VARCHAR)) AS i FROM lineitem) SELECT k AS o_orderkey, string_agg(v, ',' ORDER BY half, i) AS found FROM (SELECT k, v, half, i FROM (SELECT k, s AS v, 1 AS half, i FROM l UNION ALL SELECT k, p, 2, i FROM l) QUALIFY row_number() OVER (PARTITION BY k, v ORDER BY half, i) = 1) GROUP BY 1")
def ordered_union(spark, sf_dir):
    """Two lists as one without repeats, in order of first place."""
    listed = F.array_sort(F.collect_list(F.struct("l_linenumber", text_of("l_suppkey").alias("s"), text_of("l_partkey").alias("p"))))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(listed.alias("l"))
    return rows.select("o_orderkey", F.array_join(dedupe.ordered_distinct(F.col("l.s"), F.col("l.p")), ",").alias("found"))


SQL_SIGNALS = "CASE WHEN o_orderstatus = 'O' THEN '; signals: a, b, c, d' WHEN o_orderstatus = 'F' THEN '; signals: a' ELSE '' END"


@query("rationale", f"SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'A watched source changed several times; confirm what was released.' WHEN o_orderpriority = '1-URGENT' THEN 'Asked for at once' || {SQL_SIGNALS} || '.' ELSE 'Asked for' || {SQL_SIGNALS} || '.' END AS why FROM orders")
def rationale(spark, sf_dir):
    signals = F.when(F.col("o_orderstatus") == "O", F.array(*map(F.lit, "abcde"))).when(F.col("o_orderstatus") == "F", F.array(F.lit("a"))).otherwise(F.array().cast("array<string>"))
    track = F.when(F.col("o_orderpriority") == "5-LOW", "track.fixed").otherwise("track.emerging")
    return table(spark, sf_dir, "orders").select("o_orderkey", select.rationale(F.lit("balanced"), track, F.col("o_orderpriority"), signals, {"1-URGENT": "Asked for at once"}, "Asked for").alias("why"))


@query("focus_context", "SELECT r_name, 'watchlist_focus:' || string_agg(n_name, ',' ORDER BY n_name) AS context FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1")
def focus_context(spark, sf_dir):
    terms = F.concat(F.array(F.lit(" ")), F.array_sort(F.collect_list("n_name")))
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("r_name").agg(terms.alias("t")).select("r_name", records.focus_context(F.col("t")).alias("context"))


def wanted_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.concat(F.lit("s"), text_of("o_orderkey"))
    asked = orders.select(text_of("o_orderkey").alias("candidate_id"), F.col("o_orderpriority").alias("canonical_title"), F.col("o_orderstatus").alias("primary_route"), F.floor(F.col("o_totalprice") / 10000).cast("int").alias("score"), F.array(F.lit("routing_context:x"), F.lit("a")).alias("matched_signals"), F.array(key).alias("source_ids"))
    known = orders.select(key.alias("source_id"), F.lit("p").alias("publisher"), F.lit("news").alias("source_type"), F.col("o_orderpriority").alias("raw_title"), F.lit("short").alias("raw_excerpt"), F.lit(None).cast("string").alias("raw_text"), F.lit("https://o.org/").alias("canonical_url"))
    return enrich.inputs(asked, joins.members(asked, known))


@query(
    "enrichment",
    "WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS candidate_id, o_orderstatus = 'F' AS cached, least(100, 4 * CAST(floor(o_totalprice / 10000) AS INTEGER)) AS s FROM orders) SELECT candidate_id, cached, CAST(CASE WHEN cached THEN 1 ELSE s END AS INTEGER) AS importance, CASE WHEN cached THEN 'p2' WHEN s >= 70 THEN 'p1' ELSE 'p2' END AS disposition, 's' || candidate_id AS source_ids FROM o",
)
def enrichment(spark, sf_dir):
    """Answers of the stub for inputs that the cache does not hold; a cached row without a fingerprint counts for none."""
    wanted = wanted_inputs(spark, sf_dir)
    done = table(spark, sf_dir, "orders").select(text_of("o_orderkey").alias("candidate_id"), (F.col("o_orderstatus") == "F").alias("ok"))
    answer = F.to_json(F.struct("candidate_id", F.lit(1).alias("importance_score"), F.lit("p2").alias("recommended_disposition"), F.array(F.concat(F.lit("s"), "candidate_id")).alias("source_ids")))
    cache = wanted.join(done, "candidate_id").select("candidate_id", F.when(F.col("ok"), F.col("fingerprint")).alias("fingerprint"), answer.alias("answer"))
    made = enrich.enrich(wanted, cache.unionByName(cache))
    return made.select("candidate_id", "cached", F.col("analysis.importance_score").alias("importance"), F.col("analysis.recommended_disposition").alias("disposition"), F.array_join("analysis.source_ids", ",").alias("source_ids"))


@query(
    "answer_violations",
    """WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS key, * FROM orders), g AS (SELECT * FROM o WHERE o_orderstatus <> 'P')
    SELECT 'type' AS rule, key FROM g WHERE o_orderpriority = '5-LOW' UNION ALL SELECT 'type_reason', key FROM g WHERE o_orderpriority = '2-HIGH'
    UNION ALL SELECT 'high_score_rejected', key FROM g WHERE o_totalprice >= 70000 AND o_orderpriority = '3-MEDIUM' UNION ALL SELECT 'overconfident', key FROM g WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'placeholder', key FROM g WHERE o_orderpriority = '4-NOT SPECIFIED' UNION ALL SELECT 'missing', key FROM o WHERE o_orderstatus = 'P'""",
)
def answer_violations(spark, sf_dir):
    """Answers that break each rule; orders in progress have none."""
    orders, level = table(spark, sf_dir, "orders"), F.col("o_orderpriority")
    asked = orders.select(text_of("o_orderkey").alias("candidate_id"))
    told = orders.filter("o_orderstatus <> 'P'").select(
        text_of("o_orderkey").alias("candidate_id"),
        F.when(level == "5-LOW", "other").otherwise("news").alias("intelligence_type"),
        F.when(level == "2-HIGH", " ").otherwise("said").alias("intelligence_type_reason"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("importance_score"),
        F.lit(None).cast("int").alias("strategy_relevance_score"),
        F.when(level == "3-MEDIUM", "reject").otherwise("p1").alias("recommended_disposition"),
        F.when(level == "1-URGENT", "high").otherwise("low").alias("confidence"),
        F.array(F.when(level == "4-NOT SPECIFIED", " TBD ").otherwise("It was ordered.")).alias("proposed_claims"),
    )
    return enrich.violations(told, asked, ["news"])


# ---------------------------------------------------------------- parsers, a page per customer

SQL_PAGE = "(SELECT *, CAST(o_custkey AS VARCHAR) AS registry_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS place, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders WHERE o_custkey IS NOT NULL)"


def customer_pages(spark: SparkSession, sf_dir: str, piece, begin: str = "", end: str = "", between: str = "\n") -> DataFrame:
    """(registry_id, url, body): a page of a customer, a piece for each order."""
    listed = F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")))
    rows = table(spark, sf_dir, "orders").filter("o_custkey is not null").groupBy("o_custkey").agg(listed.alias("o"))
    body = F.concat(F.lit(begin), F.array_join(F.transform("o", piece), between), F.lit(end))
    return rows.select(text_of("o_custkey").alias("registry_id"), F.concat(F.lit("https://n.org/news?c="), text_of("o_custkey")).alias("url"), body.alias("body"))


def key_of(x):
    return x["o_orderkey"].cast("string")


def day_of(x, form: str = "yyyy-MM-dd"):
    return F.date_format(x["o_orderdate"], form)


@query("card_rows", f"SELECT registry_id, place, 'https://n.org/p/' || o_orderkey AS issue_url, o_orderpriority || ' & co' AS title, o_orderstatus AS excerpt, d FROM {SQL_PAGE}")
def card_rows(spark, sf_dir):
    """Cards of a newsletter index, read from JSON in a script; one card is there twice."""
    card = lambda x: F.concat(F.lit('{"title":"'), x["o_orderpriority"], F.lit(' &amp; co","excerpt":"'), x["o_orderstatus"], F.lit('","href":"/p/'), key_of(x), F.lit('","date":"'), day_of(x), F.lit('"}'))
    pages = customer_pages(spark, sf_dir, card, "<script>[", "]</script>", ",")
    # As scripts carry it: JSON inside a string, its quotes escaped.
    twice = F.replace(F.concat("body", F.regexp_extract("body", r"\{[^{}]*\}", 0)), F.lit('"'), F.lit('\\"'))
    return landed.issue_cards(pages.withColumn("body", twice)).select("registry_id", "place", "issue_url", "title", "excerpt", F.to_date("issue_date").cast("string").alias("d"))


SQL_NULL_STATUS = "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END"


def null_status(x):
    return F.when(x["o_orderstatus"] != "P", F.concat(F.lit('"'), x["o_orderstatus"], F.lit('"'))).otherwise("null")


@query("nested_card_rows", f"SELECT registry_id, place, 'https://n.org/p/' || o_orderkey AS issue_url, '{{' || o_orderpriority || '}} \"co\"' AS title, {SQL_NULL_STATUS} AS excerpt, d FROM {SQL_PAGE}")
def nested_card_rows(spark, sf_dir):
    """Cards with an author object that has a title too, null excerpts and members in two orders, in a string of a script."""
    author = F.lit('"author":{"title":"Dr","tags":["]",{"date":"x"}]}')
    named = lambda x: F.concat(F.lit('"title":"{'), x["o_orderpriority"], F.lit('} \\"co\\""'))
    link = lambda x: F.concat(F.lit('"href":"/p/'), key_of(x), F.lit('"'))
    rest = lambda x: F.concat(F.lit('"excerpt":'), null_status(x), F.lit(',"date":"'), day_of(x), F.lit('"'))
    card = lambda x: F.concat(F.lit("{"), F.when(x["o_orderkey"] % 2 == 0, F.concat_ws(",", named(x), author, link(x), rest(x))).otherwise(F.concat_ws(",", rest(x), link(x), author, named(x))), F.lit("}"))
    pages = customer_pages(spark, sf_dir, card, '["$","ul",null,{"cards":[', "]}]", ",")
    # As frameworks do: the data is a string that JavaScript passes on, with other brackets around.
    escaped = F.replace(F.replace("body", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    body = F.concat(F.lit('<p>{"title":"not a script"}</p><script>var a={b:[1,};</script><script>self.push([1,"1:'), escaped, F.lit('"])</script>'))
    return landed.issue_cards(pages.withColumn("body", body)).select("registry_id", "place", "issue_url", "title", "excerpt", F.to_date("issue_date").cast("string").alias("d"))


@query("item_rows", f"SELECT registry_id, place, 'https://n.org/i/' || o_orderkey AS url, o_orderpriority AS name FROM {SQL_PAGE} WHERE place < 20")
def item_rows(spark, sf_dir):
    """The linked data's list of at most twenty items."""
    item = lambda x: F.to_json(F.struct(F.concat(F.lit("https://n.org/i/"), key_of(x)).alias("url"), x["o_orderpriority"].alias("name")))
    return landed.item_list(customer_pages(spark, sf_dir, item, '<script type="application/ld+json">{"mainEntity":{"@type":"ItemList","itemListElement":[', "]}}</script>", ","))


@query("embedded_rows", f"SELECT registry_id, place, 'paper ' || o_orderkey AS title, 'https://n.org/en-US/document-' || o_orderkey AS url, d FROM {SQL_PAGE}")
def embedded_rows(spark, sf_dir):
    """Documents in a page's embedded JSON, dated in milliseconds."""
    ms = lambda x: (F.unix_timestamp(x["o_orderdate"].cast("timestamp")) * 1000).cast("string")
    piece = lambda x: F.concat(F.lit('{"documentId":'), key_of(x), F.lit(',"documentPublishTime":'), ms(x), F.lit(',"documentTitle":"paper '), key_of(x), F.lit('"}'))
    return landed.embedded_documents(customer_pages(spark, sf_dir, piece, "<script>window.x=[", "]</script>", ",")).select("registry_id", "place", "title", "url", F.to_date("published_at").cast("string").alias("d"))


@query("nested_embedded_rows", f"SELECT registry_id, place, 'paper \"' || o_orderkey || '\"' AS title, 'https://n.org/en-US/document-' || o_orderkey AS url, d FROM {SQL_PAGE}")
def nested_embedded_rows(spark, sf_dir):
    """Documents with members in another order, numbers as text and objects between them; one without a time is left out."""
    ms = lambda x: (F.unix_timestamp(x["o_orderdate"].cast("timestamp")) * 1000).cast("string")
    time = lambda x: F.when(x["o_orderkey"] % 3 == 0, F.concat(F.lit('"'), ms(x), F.lit('"'))).otherwise(ms(x))
    piece = lambda x: F.concat(F.lit('{"documentTitle":"paper \\"'), key_of(x), F.lit('\\"","more":[{"documentId":0,"documentTitle":"part"},[null,{}]],"documentPublishTime":'), time(x), F.lit(',"documentId":"'), key_of(x), F.lit('"},{"documentId":1,"documentTitle":"none"}'))
    return landed.embedded_documents(customer_pages(spark, sf_dir, piece, "<script>if(a<b){x={y:", "}</script>", "}{").withColumn("body", F.replace("body", F.lit("{y:"), F.lit("[")))).select("registry_id", "place", "title", "url", F.to_date("published_at").cast("string").alias("d"))


@query("unclosed_link_rows", f"SELECT registry_id, place, 'Report of order ' || o_orderkey AS title, 'https://n.org/r/' || o_orderkey AS url, d FROM {SQL_PAGE}")
def unclosed_link_rows(spark, sf_dir):
    """Links in list items that nobody ends, below more than a hundred elements."""
    piece = lambda x: F.concat(F.lit('<li><p><a href="/r/'), key_of(x), F.lit('">Report of <b>order '), key_of(x), F.lit("</b></a> <i>"), day_of(x, "yyyy.M.d"), F.lit("</i>"))
    return landed.dated_links(customer_pages(spark, sf_dir, piece, "<div>" * 120 + "<ul>", "</ul>")).select("registry_id", "place", "title", "url", F.to_date("published_at").cast("string").alias("d"))


@query("dated_link_rows", f"SELECT registry_id, place, 'Report of order ' || o_orderkey AS title, 'https://n.org/r/' || o_orderkey AS url, d FROM {SQL_PAGE}")
def dated_link_rows(spark, sf_dir):
    """Links with the date that follows each."""
    piece = lambda x: F.concat(F.lit('<li><a href="/r/'), key_of(x), F.lit('">Report of <b>order '), key_of(x), F.lit("</b></a> <i>"), day_of(x, "yyyy.M.d"), F.lit("</i></li>"))
    return landed.dated_links(customer_pages(spark, sf_dir, piece, "<ul>", "</ul>")).select("registry_id", "place", "title", "url", F.to_date("published_at").cast("string").alias("d"))


@query("announcement_rows", f"SELECT registry_id, place, o_orderstatus AS category, 'Notice ' || o_orderkey AS title, 'https://n.org/n/' || o_orderkey || '.pdf' AS url, CAST(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 90 MINUTE AS VARCHAR) AS at FROM {SQL_PAGE}")
def announcement_rows(spark, sf_dir):
    """Rows of an exchange's table, half past nine in its zone."""
    piece = lambda x: F.concat(F.lit("<tr><td>"), day_of(x, "dd/MM/yyyy"), F.lit(' 09:30</td><td><div class="headline">'), x["o_orderstatus"], F.lit('</div><div class="doc-link"><a href="/n/'), key_of(x), F.lit('.pdf">Notice '), key_of(x), F.lit("</a></div></td></tr>"))
    return landed.announcements(customer_pages(spark, sf_dir, piece, "<table>", "</table>")).select("registry_id", "place", "category", "title", "url", text_of("published_at").alias("at"))


@query("section_rows", f"SELECT 'https://n.org/news?c=' || registry_id AS url, 'A. Writer' AS author, CAST(place + 1 AS INTEGER) AS place, 's' || o_orderkey AS section_id, o_orderpriority AS title, o_orderstatus || '|' || d AS paragraphs FROM {SQL_PAGE}")
def section_rows(spark, sf_dir):
    """Sections of an issue page after its marker."""
    piece = lambda x: F.concat(F.lit('<h1 id="s'), key_of(x), F.lit('">'), x["o_orderpriority"], F.lit("</h1><p>"), x["o_orderstatus"], F.lit("</p><p>"), day_of(x), F.lit("</p>"))
    pages = customer_pages(spark, sf_dir, piece, '<meta name="author" content="A. Writer"><h1 id="intro">Hello</h1><p>no</p><h1 id="news">News</h1>')
    return landed.sections(pages).select("url", "author", "place", "section_id", "title", F.array_join("paragraphs", "|").alias("paragraphs"))


@query("unclosed_section_rows", f"SELECT 'https://n.org/news?c=' || registry_id AS url, 'A. Writer' AS author, CAST(place + 1 AS INTEGER) AS place, 's' || o_orderkey AS section_id, o_orderpriority AS title, o_orderstatus || ' & ' || d || '|' || d || '|one' AS paragraphs FROM {SQL_PAGE}")
def unclosed_section_rows(spark, sf_dir):
    """Sections whose paragraphs, list items and table cells nobody ends, deep in the page."""
    deep = "<span>" * 90
    piece = lambda x: F.concat(F.lit('<h1 id="s'), key_of(x), F.lit(f'">{deep}'), x["o_orderpriority"], F.lit(f"</h1><p>{deep}"), x["o_orderstatus"], F.lit(" &amp; "), day_of(x), F.lit("<script>no()</script><p>"), day_of(x), F.lit("<table><tr><td><p>one<td>two<tr><td>three</table><ul><li>four<li>five</ul>"))
    pages = customer_pages(spark, sf_dir, piece, '<meta name="author" content="A. Writer"><h1 id="intro">Hello</h1><p>no<h1 id="news">News</h1>')
    return landed.sections(pages).select("url", "author", "place", "section_id", "title", F.array_join("paragraphs", "|").alias("paragraphs"))


@query("unclosed_announcement_rows", f"SELECT registry_id, place, o_orderstatus AS category, 'Notice ' || o_orderkey AS title, 'https://n.org/n/' || o_orderkey || '.pdf' AS url, CAST(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 90 MINUTE AS VARCHAR) AS at FROM {SQL_PAGE}")
def unclosed_announcement_rows(spark, sf_dir):
    """Rows and cells of an exchange's table that nobody ends."""
    piece = lambda x: F.concat(F.lit("<tr><td>"), day_of(x, "dd/MM/yyyy"), F.lit(' 09:30<td><div class="headline">'), x["o_orderstatus"], F.lit('</div><div class="doc-link"><a href="/n/'), key_of(x), F.lit('.pdf">Notice '), key_of(x), F.lit("</a></div>"))
    return landed.announcements(customer_pages(spark, sf_dir, piece, "<div>" * 100 + "<table><tbody>", "</table>")).select("registry_id", "place", "category", "title", "url", text_of("published_at").alias("at"))


@query("api_rows", f"SELECT registry_id, 'https://n.org/a/' || o_orderkey AS url, CAST(o_orderkey AS VARCHAR) AS raw_title, o_orderstatus AS publisher, d FROM {SQL_PAGE} WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND CAST(o_orderdate AS TIMESTAMP) BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{UNTIL}'")
def api_rows(spark, sf_dir):
    """Articles of landed API pages: allowed feeds, in the window."""
    piece = lambda x: F.to_json(F.struct(x["o_orderpriority"].alias("mp_id"), x["o_orderstatus"].alias("mp_name"), key_of(x).alias("title"), F.concat(F.lit("https://n.org/a/"), key_of(x)).alias("url"), F.unix_timestamp(x["o_orderdate"].cast("timestamp")).alias("publish_time")))
    pages = customer_pages(spark, sf_dir, piece, '{"list":[', "]}", ",").withColumn("offset", F.lit(0))
    allowed = table(spark, sf_dir, "orders").filter("o_orderpriority in ('1-URGENT', '2-HIGH')").select(F.col("o_orderpriority").alias("mp_id")).distinct()
    return landed.api_records(landed.api_articles(pages, allowed, *span())).select("registry_id", "url", "raw_title", "publisher", F.to_date("published_at").cast("string").alias("d"))


@query("extracted_rows", "SELECT conv_id || '/' || turn AS url, role AS title, CASE WHEN text <> '' THEN sha256(text) END AS body_hash, CASE WHEN text <> '' THEN 'internal_text' ELSE 'metadata_only' END AS rights_scope FROM conversations")
def extracted_rows(spark, sf_dir):
    """Articles of extractor JSON, whose members have several names."""
    turns = table(spark, sf_dir, "conversations")
    payload = F.to_json(F.struct(F.concat_ws("/", text_of("conv_id"), text_of("turn")).alias("news_url"), F.col("role").alias("news_title"), F.col("text").alias("content")))
    got = landed.extracted_articles(turns.select(F.lit("x").alias("registry_id"), payload.alias("payload")))
    return got.select("url", "title", F.sha2(F.col("body").cast("binary"), 256).alias("body_hash"), "rights_scope")


@query(
    "extracted_upsert",
    """WITH e AS (SELECT conv_id AS k, max(CASE WHEN role = 'user' AND trim(text) <> '' THEN {'a': turn, 't': text} END) AS good, max(CASE WHEN role <> 'user' OR trim(text) = '' THEN turn END) AS bad FROM conversations GROUP BY 1)
    SELECT CAST(doc_id AS VARCHAR) AS source_id, sha256(CASE WHEN good IS NOT NULL THEN good.t ELSE text END) AS text_hash,
      CASE WHEN good IS NOT NULL THEN 'internal_text' ELSE 'excerpt' END AS rights_scope, CASE WHEN good IS NULL AND bad IS NOT NULL THEN 'failed at ' || bad END AS failure_reason,
      CASE WHEN good IS NOT NULL THEN sha256(lang || chr(10) || good.t || chr(10)) ELSE 'old' END AS content_hash
    FROM documents LEFT JOIN e ON k = doc_id""",
)
def extracted_upsert(spark, sf_dir):
    """Documents whose text the last user turn of the conversation of their number replaces; other turns are failures."""
    docs, turns = table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations")
    have = docs.select(text_of("doc_id").alias("source_id"), F.col("lang").alias("raw_title"), F.col("text").alias("raw_text"), F.lit(None).cast("string").alias("raw_excerpt"), F.lit("old").alias("content_hash"), F.lit("excerpt").alias("rights_scope"), F.lit("success").alias("access_status"), F.lit(None).cast("string").alias("failure_reason"))
    found = turns.select(text_of("conv_id").alias("source_id"), F.col("turn").alias("attempt"), F.when(F.col("role") == "user", F.col("text")).alias("text"), F.concat(F.lit("failed at "), text_of("turn")).alias("reason"))
    made = landed.upsert_texts(have, found)
    return made.select("source_id", F.sha2(F.col("raw_text"), 256).alias("text_hash"), "rights_scope", "failure_reason", "content_hash")


SQL_IN_SPAN = f"CAST(o_orderdate AS TIMESTAMP) BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{UNTIL}'"


@query(
    "listed_articles",
    f"""SELECT registry_id, place, 'https://n.org/i/' || o_orderkey AS url, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN o_orderpriority ELSE 'On ' || o_orderkey || ' & more' END AS raw_title,
      CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS raw_excerpt, CASE WHEN o_orderkey % 5 <> 0 THEN d END AS d, CASE WHEN o_orderkey % 5 = 0 THEN 'not fetched' END AS failure_reason
    FROM {SQL_PAGE} WHERE place < 20 AND (o_orderkey % 5 = 0 OR ({SQL_IN_SPAN} AND o_orderpriority IN ('1-URGENT', '2-HIGH')))""",
)
def listed_articles(spark, sf_dir):
    """Items of a page's list with their articles' pages: some without a title, some not landed, some landed twice."""
    item = lambda x: F.to_json(F.struct(F.concat(F.lit("https://n.org/i/"), key_of(x)).alias("url"), x["o_orderpriority"].alias("name")))
    items = landed.item_list(customer_pages(spark, sf_dir, item, '<script type="application/ld+json">{"mainEntity":{"@type":"ItemList","itemListElement":[', "]}}</script>", ","))
    orders = table(spark, sf_dir, "orders").filter("o_orderkey % 5 <> 0")
    title = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.concat(F.lit('<meta property="og:title" content="On '), text_of("o_orderkey"), F.lit(' &amp; more">')))
    body = F.concat(title, F.lit('<meta content="'), "o_orderpriority", F.lit('" name="description"><meta property="article:published_time" content="'), text_of("o_orderdate"), F.lit('">'))
    pages = orders.select(F.concat(F.lit("https://n.org/i/"), text_of("o_orderkey")).alias("url"), F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt"), body.alias("body")).withColumn("reason", F.when(F.col("attempt") == 1, "timeout"))
    pages = pages.withColumn("body", F.when(F.col("attempt") == 2, F.col("body")))
    made = articles.listed(items, pages, *span(), ["urgent", "high"])
    return made.select("registry_id", "place", "url", "raw_title", "raw_excerpt", F.to_date("published_at").cast("string").alias("d"), "failure_reason")


SQL_FED = f"""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY registry_id ORDER BY place) AS r FROM {SQL_PAGE} WHERE {SQL_IN_SPAN}),
c AS (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN 'blocked' WHEN o_orderkey % 9 = 0 THEN 'not fetched' END AS why FROM f WHERE r <= 3),
m AS (SELECT * FROM c WHERE why IS NOT NULL OR o_orderkey % 6 <> 1)"""


def fed_articles(spark: SparkSession, sf_dir: str):
    """(scanned, chosen, articles): a customer's orders as feed entries, the first three in the window with what was extracted."""
    pages = customer_pages(spark, sf_dir, lambda x: F.to_json(F.struct(key_of(x).alias("k"), day_of(x).alias("d"))), "[", "]", ",")
    entries = pages.select("registry_id", F.posexplode(F.from_json("body", "array<struct<k:string,d:string>>")).alias("place", "e"))
    entries = entries.select("registry_id", "place", F.concat(F.lit("http://m.n.org/a/"), F.col("e.k")).alias("link"), F.col("e.k").alias("title"), F.lit(None).cast("string").alias("excerpt"), F.col("e.d").cast("timestamp").alias("at"))
    chosen = landed.discovered(entries.filter(predicates.in_window(F.col("at"), *span())), [("http://m.", "https://www.")], r"^https://www\.n\.org/", [], 3)
    chosen = chosen.select("registry_id", "place", F.col("link").alias("url"), F.when(F.col("title").cast("bigint") % 2 == 0, F.lit("Even desk")).alias("publisher"))
    key = F.col("o_orderkey")
    told = F.to_json(F.struct(F.concat(F.lit("https://n.org/final/"), text_of("o_orderkey")).alias("link"), F.concat(F.lit("t"), text_of("o_orderkey")).alias("news_title"), F.col("o_orderstatus").alias("content"), F.when(key % 6 == 1, "1990-01-01").otherwise(text_of("o_orderdate")).alias("publish_time")))
    payloads = table(spark, sf_dir, "orders").filter("o_orderkey % 4 = 0 or o_orderkey % 9 <> 0").select(F.concat(F.lit("https://www.n.org/a/"), text_of("o_orderkey")).alias("url"), F.lit(1).alias("attempt"), F.when(key % 4 != 0, told).alias("payload"), F.lit("blocked").alias("reason"))
    made = articles.extracted(chosen, payloads.union(payloads), *span())
    return entries.groupBy("registry_id").agg(F.count("*").alias("scanned")), chosen, made


@query(
    "feed_articles",
    f"{SQL_FED} SELECT registry_id, place, CASE WHEN why IS NULL THEN 'https://n.org/final/' ELSE 'https://www.n.org/a/' END || o_orderkey AS url, CASE WHEN why IS NULL THEN 't' || o_orderkey END AS raw_title, CASE WHEN why IS NULL THEN o_orderstatus END AS raw_text, CASE WHEN o_orderkey % 2 = 0 THEN 'Even desk' END AS publisher, why AS failure_reason FROM m",
)
def feed_articles(spark, sf_dir):
    """What an extractor gave for chosen feed entries: failures by entry, nothing outside the window, a repeated result once."""
    return fed_articles(spark, sf_dir)[2].select("registry_id", "place", "url", "raw_title", "raw_text", "publisher", "failure_reason")


@query(
    "extraction_health",
    f"""{SQL_FED}, n AS (SELECT registry_id, count(*) AS scanned FROM {SQL_PAGE} GROUP BY 1), s AS (SELECT registry_id, count(*) AS selected FROM c GROUP BY 1),
    g AS (SELECT registry_id, count(*) FILTER (why IS NULL) AS accepted, count(why) AS failures, min(why) AS error FROM m GROUP BY 1)
    SELECT n.registry_id, CASE WHEN coalesce(selected, 0) > 0 AND coalesce(failures, 0) >= selected THEN 'failed' ELSE 'success' END AS status, scanned, coalesce(selected, 0) AS selected, coalesce(accepted, 0) AS accepted, coalesce(failures, 0) AS extraction_failures, error
    FROM n LEFT JOIN s USING (registry_id) LEFT JOIN g USING (registry_id)""",
)
def extraction_health(spark, sf_dir):
    scanned, chosen, made = fed_articles(spark, sf_dir)
    return articles.health(chosen, made, scanned)


@query(
    "pdf_upsert",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN sha256('[Page 1] ' || doc_id) ELSE 'old' END AS text_hash, CASE WHEN doc_id % 3 = 0 THEN sha256(lang || chr(10) || '[Page 1] ' || doc_id || chr(10) || 'x') ELSE 'old' END AS content_hash,
      CASE WHEN doc_id % 3 = 0 THEN 'text_extracted' WHEN doc_id % 3 = 1 THEN 'pdf_text_needs_review' ELSE 'collected' END AS processing_status, CASE WHEN doc_id % 3 = 0 THEN 'seen; pdf_pages:2' ELSE 'seen' END AS discovery_context FROM documents""",
)
def pdf_upsert(spark, sf_dir):
    """Documents as records of PDFs, of pages, and of PDFs that could not be read; readings repeat."""
    key = F.col("doc_id")
    url = F.concat(F.lit("https://e.org/"), text_of("doc_id"), F.when(key % 3 == 2, ".html").otherwise(".PDF?v=1"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", url.alias("u"))
    have = docs.select("doc_id", F.col("u").alias("canonical_url"), F.lit("success").alias("access_status"), F.col("lang").alias("raw_title"), F.lit("old").alias("raw_text"), F.lit(None).cast("string").alias("raw_excerpt"), F.lit("old").alias("content_hash"), F.lit("excerpt").alias("rights_scope"), F.lit("collected").alias("processing_status"), F.lit("seen").alias("discovery_context"))
    read = docs.select(F.col("u").alias("url"), F.explode(F.array(F.lit("failed"), F.when(key % 3 != 1, "success").otherwise("failed"))).alias("status"), F.concat(F.lit("[Page 1] "), text_of("doc_id")).alias("t"))
    ok = F.col("status") == "success"
    read = read.select("url", "status", F.when(ok, F.col("t")).alias("full_text"), F.when(ok, "x").alias("excerpt"), F.when(ok, 2).alias("n_pages"))
    hashed = F.when(F.col("raw_text") == "old", "old").otherwise(F.sha2("raw_text", 256))
    return articles.attach_pdf(have, read).select("doc_id", hashed.alias("text_hash"), "content_hash", "processing_status", "discovery_context")


@query(
    "changed_pages",
    "SELECT page_id, 'The sitemap says that this page changed at ' || strftime(TIMESTAMP '2024-01-01' + to_days(CAST(page_id % 400 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') || '.' AS raw_excerpt FROM pages WHERE contains(lower(trim(url)), 'http') AND NOT contains(lower(trim(url)), '7') AND page_id % 400 BETWEEN 10 AND 200",
)
def changed_pages(spark, sf_dir):
    """Addresses of sitemaps by included and excluded terms, changed in the window."""
    loc = F.replace(F.trim("url"), F.lit("&"), F.lit("&amp;"))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(400)).cast("int")), "yyyy-MM-dd")
    maps = table(spark, sf_dir, "pages").select(text_of("page_id").alias("registry_id"), F.concat(F.lit("<urlset><url><loc>"), loc, F.lit("</loc><lastmod>"), day, F.lit("</lastmod></url></urlset>")).alias("body"))
    made = articles.changed_pages(landed.sitemap(maps), F.lit("2024-01-11").cast("timestamp"), F.lit("2024-07-19").cast("timestamp"), ["http"], ["7"])
    return made.select(F.col("registry_id").cast("bigint").alias("page_id"), "raw_excerpt")


@query(
    "api_health",
    f"""WITH o AS (SELECT *, place // 2 AS page FROM {SQL_PAGE}), n AS (SELECT registry_id, count(*) AS total, CAST(registry_id AS BIGINT) AS c FROM o GROUP BY 1),
    s AS (SELECT *, CASE WHEN c % 5 = 0 AND total > 2 THEN 2 WHEN c % 5 = 1 THEN least(total, 4) ELSE total END AS there FROM n),
    a AS (SELECT registry_id, count(DISTINCT o_orderpriority) AS matched, list_sort(list_distinct(list_filter(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], lambda x: NOT list_contains(list(o_orderpriority), x)))) AS missing FROM o GROUP BY 1)
    SELECT registry_id, CASE WHEN c % 7 = 0 THEN 'no_login' WHEN least(total, 6) > there THEN 'gap' ELSE 'complete' END AS state, CASE WHEN c % 7 = 0 THEN 'failed' ELSE 'success' END AS status,
      least(there, 6)::BIGINT AS scanned, total AS available, there AS accepted, 5::BIGINT AS configured, matched, array_to_string(missing, ',') AS missing
    FROM s JOIN a USING (registry_id)""",
)
def api_health(spark, sf_dir):
    """A customer's orders as pages of two; of some the second page, of others all from the third on, was not landed."""
    orders = table(spark, sf_dir, "orders").filter("o_custkey is not null")
    listed = F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority")))
    rows = orders.groupBy(text_of("o_custkey").alias("registry_id")).agg(listed.alias("o"), F.min("o_custkey").alias("c"))
    paged = rows.select("registry_id", "c", F.size("o").alias("total"), "o", F.explode(F.sequence(F.lit(0), F.expr("(size(o) - 1) div 2"))).alias("page"))
    there = paged.filter(~((F.col("c") % 5 == 0) & (F.col("page") == 1)) & ~((F.col("c") % 5 == 1) & (F.col("page") >= 2)))
    items = F.transform(F.slice("o", F.col("page") * 2 + 1, F.lit(2)), lambda x: F.struct(x["o_orderkey"].cast("string").alias("title")))
    pages = there.select("registry_id", (F.col("page") * 2).alias("offset"), F.to_json(F.struct(items.alias("list"), "total")).alias("body"))
    feeds = orders.select(text_of("o_custkey").alias("registry_id"), F.col("o_orderpriority").alias("mp_name")).distinct()
    wanted = rows.select("registry_id", F.explode(F.array(*map(F.lit, ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]))).alias("account_name"), F.lit(True).alias("enabled"))
    logins = rows.select("registry_id", F.to_json(F.struct((F.col("c") % 7 != 0).alias("login_status"))).alias("body"))
    kept = landed.api_pages(pages, 1000).filter("reached").select("registry_id", F.explode(F.sequence(F.lit(1), F.col("items").cast("int"))))
    made = landed.api_health(pages.union(pages), feeds, wanted, logins, kept, most=6)
    return made.withColumn("missing", F.array_join("missing", ","))


@query(
    "schema_violations",
    """WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey % 12 AS k FROM orders)
    SELECT rule, key, field FROM o JOIN (VALUES (0, 'not_json', ''), (1, 'missing', 'why'), (2, 'extra', 'more'), (3, 'type', 'importance_score'), (4, 'value', 'novelty_score'), (5, 'type', 'what'), (6, 'value', 'confidence'), (7, 'type', 'proposed_claims'), (8, 'value', 'secondary_routes'), (9, 'value', 'intelligence_type'), (10, 'not_json', '')) AS v(k, rule, field) USING (k)""",
)
def schema_violations(spark, sf_dir):
    """Answers of which eleven in twelve break one rule each."""
    k = F.col("o_orderkey") % 12
    text, names = F.lit("said"), {"intelligence_type": "news", "primary_route": "r", "track": "track.fixed", "confidence": "low", "recommended_disposition": "p1"}
    have = {f: F.lit(names.get(f, "said")) for f in enrich.TEXT_FIELDS} | {f: F.array(F.lit("r")) for f in enrich.LIST_FIELDS} | {f: F.lit(7) for f in enrich.SCORE_FIELDS}
    have |= {"why": F.when(k != 1, text), "confidence": F.when(k == 6, "sure").otherwise("low"), "intelligence_type": F.when(k == 9, "odd").otherwise("news"), "novelty_score": F.when(k == 4, 101).otherwise(100)}
    have |= {"secondary_routes": F.when(k == 8, F.array(F.lit("r"), F.lit("s"))).otherwise(F.array().cast("array<string>"))}
    said = F.to_json(F.struct(*[v.alias(f) for f, v in have.items()]))
    said = F.when(k == 2, F.replace(said, F.lit('{"'), F.lit('{"more":1,"'))).when(k == 3, F.replace(said, F.lit('"importance_score":7'), F.lit('"importance_score":7.5'))).when(k == 5, F.replace(said, F.lit('"what":"said"'), F.lit('"what":null'))).when(k == 7, F.replace(said, F.lit('"proposed_claims":["r"]'), F.lit('"proposed_claims":["r",{"a":1}]'))).otherwise(said)
    answers = table(spark, sf_dir, "orders").select(text_of("o_orderkey").alias("candidate_id"), F.when(k == 0, F.lit("[1]")).when(k == 10, F.lit("{nope")).otherwise(said).alias("answer"))
    return enrich.schema_violations(answers, ["news"], ["r"])


SQL_ISSUES = """
e AS (SELECT o_custkey AS k, CAST(o_orderkey AS VARCHAR) AS id, 'story_' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 12) AS sid, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p, o_orderstatus AS s, o_totalprice AS price,
    row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 9 END, o_orderdate, CAST(o_orderkey AS VARCHAR)) - 1 AS rank,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) - 1 AS place FROM orders WHERE o_custkey IS NOT NULL),
g AS (SELECT k, min(d) AS low, max(d) AS high, greatest(max(d), min(d) + 6) AS e, count(*) AS n FROM e GROUP BY 1 HAVING count(*) BETWEEN 5 AND 10)"""


def issue_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories with their claims: a customer's orders are the events of an issue, whose five dearest are its long stories."""
    orders = table(spark, sf_dir, "orders").filter("o_custkey is not null")
    number, level = text_of("o_orderkey"), F.col("o_orderpriority")
    claim = lambda n: F.concat(F.lit("clm_"), number, F.lit(f"_{n}"))
    found = orders.select(
        F.col("o_custkey").alias("issue_key"), number.alias("event_id"), level.alias("canonical_title"), F.when(level == "1-URGENT", "priority.p0").when(level == "2-HIGH", "priority.p1").otherwise("other").alias("priority"),
        F.col("o_orderdate").cast("timestamp").alias("event_at"), F.col("o_orderstatus").alias("fact_summary"), F.lit("Only an order.").alias("limitations"), F.array(claim(1), claim(2)).alias("claim_ids"), number.alias("primary_source_id"), level.alias("primary_route"), F.col("o_orderstatus").alias("entity_name"), "o_totalprice",
    )
    claims = orders.select(F.explode(F.array(F.struct(claim(1).alias("claim_id"), F.concat(F.lit("first "), level).alias("claim_text")), F.struct(claim(2).alias("claim_id"), F.concat(F.lit("last "), level).alias("claim_text")))).alias("c")).select("c.*")
    reviews_ = orders.select(number.alias("event_id"), F.concat(F.lit("https://o.org/"), number).alias("url"), F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("why "), level)).alias("decision_reason"))
    dearest = Window.partitionBy("issue_key").orderBy(F.col("o_totalprice").desc(), F.col("event_id").cast("bigint"))
    tops = found.select("issue_key", "event_id", F.row_number().over(dearest).alias("place"))
    return editorial.reader_stories(found, claims, reviews_, tops=tops, labels=[("o.org", "Order book")], watch=["Is it final?"], cite=True)


@query(
    "issue_document",
    f"""WITH {SQL_ISSUES},
    days AS (SELECT k, string_agg(strftime(day, '%Y-%m-%d') || ':' || ids, '|' ORDER BY day) AS days FROM (SELECT g.k, day, coalesce(string_agg(sid, ',' ORDER BY rank), '') AS ids FROM g CROSS JOIN range(7) AS r(i) CROSS JOIN LATERAL (SELECT CAST(g.e - 6 + CAST(i AS INTEGER) AS DATE) AS day) LEFT JOIN e ON e.k = g.k AND least(g.e, greatest(g.e - 6, e.d)) = day GROUP BY 1, 2) GROUP BY 1)
    SELECT k AS issue_key, string_agg(sid, ',' ORDER BY place) FILTER (place < 5) AS tops, coalesce(string_agg(sid, ',' ORDER BY rank) FILTER (place >= 5), '') AS briefs, any_value(days.days) AS days,
      string_agg(concat_ws('/', p, s, 'first ' || p, CASE WHEN s <> 'P' THEN 'why ' || p ELSE s END, 'last ' || p, CASE WHEN place < 5 THEN 'deep_dive' ELSE 'brief' END, 'https://o.org/' || id, greatest(70, 96 - 3 * rank), 'clm_' || id || '_1'), '|' ORDER BY rank) AS stories
    FROM e JOIN g USING (k) JOIN days USING (k) GROUP BY 1""",
)
def issue_document(spark, sf_dir):
    """The issue of each customer with five to ten orders, read back from its document by path."""
    documents = editorial.issue_documents(issue_stories(spark, sf_dir))
    v = documents.select("issue_key", F.parse_json("document").alias("v"))
    get = lambda item, path, kind="string": F.variant_get(item, path, kind)
    told = lambda s: F.concat_ws("/", *[get(s, f"$.{p}") for p in ("headline", "what_happened.text", "dek", "why_it_matters.text", "under_the_hood.text", "article_type", "source_links[0].url", "editorial_score", "limitations.claim_ids[0]")])
    day = lambda d: F.concat(get(d, "$.day"), F.lit(":"), F.array_join(get(d, "$.story_ids", "array<string>"), ","))
    return v.select(
        "issue_key",
        F.array_join(get("v", "$.issue.top_story_ids", "array<string>"), ",").alias("tops"),
        F.array_join(get("v", "$.issue.brief_story_ids", "array<string>"), ",").alias("briefs"),
        F.array_join(F.transform(get("v", "$.presentation.timeline_days", "array<variant>"), day), "|").alias("days"),
        F.array_join(F.transform(get("v", "$.editorial_stories", "array<variant>"), told), "|").alias("stories"),
    )


@query(
    "document_violations",
    f"""WITH {SQL_ISSUES}, x AS (SELECT k, k % 6 AS m FROM g), z AS (SELECT e.*, m FROM e JOIN x USING (k))
    SELECT 'size' AS rule, CAST(k AS VARCHAR) AS key, '' AS place FROM e GROUP BY k HAVING count(*) NOT BETWEEN 5 AND 10
    UNION ALL SELECT 'links', CAST(k AS VARCHAR), sid FROM z WHERE m = 1
    UNION ALL SELECT unnest(['what_happened_claims', 'why_it_matters_claims', 'under_the_hood_claims', 'limitations_claims']), CAST(k AS VARCHAR), sid FROM z WHERE m = 2
    UNION ALL SELECT 'seven_days', CAST(k AS VARCHAR), '' FROM x WHERE m = 3 UNION ALL SELECT 'timeline', CAST(k AS VARCHAR), '' FROM x WHERE m = 3
    UNION ALL SELECT unnest(['why_it_matters_kind', 'limitations_kind']), CAST(k AS VARCHAR), sid FROM z WHERE m = 4
    UNION ALL SELECT 'not_json', CAST(k AS VARCHAR), '' FROM x WHERE m = 5""",
)
def document_violations(spark, sf_dir):
    """Sizes that are no issue, and documents of which five in six are spoilt in one place."""
    stories = issue_stories(spark, sf_dir)
    m, text = F.col("issue_key") % 6, F.col("document")
    spoilt = F.when(m == 1, F.replace(text, F.lit("https://"), F.lit("http://"))).when(m == 2, F.replace(text, F.lit('{"claim_id":"'), F.lit('{"claim_id":"no')))
    spoilt = spoilt.when(m == 3, F.replace(text, F.lit('"timeline_days"'), F.lit('"days"'))).when(m == 4, F.replace(text, F.lit('"judgment"'), F.lit('"fact"'))).when(m == 5, F.concat(text, F.lit("]"))).otherwise(text)
    broken = validate.documents(editorial.issue_documents(stories).withColumn("document", spoilt))
    return validate.issue_sizes(stories).withColumn("place", F.lit("")).unionByName(broken)


@query(
    "search_rows",
    f"""WITH o AS (SELECT *, CAST(o_orderdate AS TIMESTAMP) AS ts, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END, o_orderdate DESC, o_orderkey) AS n FROM orders WHERE o_custkey IS NOT NULL),
    r AS (SELECT *, min(CASE WHEN ts < TIMESTAMP '{SINCE}' THEN n END) OVER (PARTITION BY o_custkey) AS stop FROM o WHERE n <= 6),
    q AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS scanned FROM r WHERE stop IS NULL OR n <= stop)
    SELECT CAST(o_custkey AS VARCHAR) AS registry_id, 'https://n.org/abs/' || o_orderkey AS url, 'Paper ' || o_orderkey AS title, scanned, '(cat:c' || o_custkey % 3 || ' OR cat:x) AND (all:"deep video" OR all:"t' || o_custkey % 2 || '")' AS said FROM q WHERE ts BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{UNTIL}'""",
)
def search_rows(spark, sf_dir):
    """A customer's orders as results of a search, newest first in pages of four; some are out of order, behind the older ones."""
    orders = table(spark, sf_dir, "orders").filter("o_custkey is not null")
    late, at = F.when(F.col("o_orderkey") % 11 == 0, 1).otherwise(0), F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    rows = orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(late.alias("l"), (-at).alias("a"), "o_orderkey"))).alias("o"))
    paged = rows.select("o_custkey", "o", F.explode(F.sequence(F.lit(0), F.expr("(size(o) - 1) div 4"))).alias("page"))
    entry = lambda x: F.concat(F.lit("<entry><title>Paper "), x["o_orderkey"].cast("string"), F.lit('</title><link href="https://n.org/abs/'), x["o_orderkey"].cast("string"), F.lit('"/><published>'), F.date_format((-x["a"]).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</published></entry>"))
    body = F.concat(F.lit("<feed>"), F.array_join(F.transform(F.slice("o", F.col("page") * 4 + 1, F.lit(4)), entry), ""), F.lit("</feed>"))
    # The page's number is part of the parser's key and taken apart again.
    landed_pages = paged.select(F.concat_ws("/", "o_custkey", "page").alias("registry_id"), F.lit("https://n.org/api").alias("url"), body.alias("body"))
    parts = F.split("registry_id", "/")
    entries = landed.feed_entries(landed_pages).withColumns({"page": parts[1].cast("int"), "registry_id": parts[0]})
    found = landed.search_results(entries, *span(), most=6)
    key = F.col("registry_id").cast("bigint")
    said = landed.search_text(F.array(F.concat(F.lit("c"), (key % 3).cast("string")), F.lit("x")), F.array(F.lit("deep video"), F.concat(F.lit("t"), (key % 2).cast("string"))))
    return found.select("registry_id", F.col("link").alias("url"), "title", "scanned", said.alias("said"))
