import datetime as dt
import json

from pyspark.sql import functions as F

from siltworks.sources import articles, landed

LANDED = "url string, attempt int, {} string, reason string"


def window():
    return [F.lit(d).cast("timestamp") for d in ("2026-08-01", "2026-08-31")]


def payload(url="https://e.org/final", at="2026-08-05T00:00:00Z", **more):
    return json.dumps({"url": url, "title": "T", "content": "body", "publish_time": at} | more)


def test_extracted_outcomes_of_each_entry(spark):
    entries = spark.createDataFrame(
        [("s", 0, "a", "Desk"), ("s", 1, "b", None), ("s", 2, "c", None), ("s", 3, "d", None), ("s", 4, None, None), ("t", 0, "a", None), ("s", 5, "e", None), ("s", 6, "f", None)], "registry_id string, place int, url string, publisher string"
    )
    results = [
        ("a", 1, payload(), None), ("a", 2, None, "late failure"), ("a", 1, payload(), None),  # repeated, and failed later
        ("b", 1, payload(at="2020-01-01T00:00:00Z"), None),
        ("c", 1, "{}", None),
        ("d", 1, None, "timeout"), ("d", 2, " ", None),
        (None, 1, payload(), None), ("e", 1, json.dumps({"url": "u", "title": "undated"}), None),
    ]
    got = {(r.registry_id, r.place): r for r in articles.extracted(entries, spark.createDataFrame(results, LANDED.format("payload")), *window()).collect()}
    assert set(got) == {("s", 0), ("t", 0), ("s", 2), ("s", 3), ("s", 4), ("s", 6)}
    assert (got["s", 0].url, got["s", 0].raw_text, got["s", 0].publisher, got["s", 0].access_status) == ("https://e.org/final", "body", "Desk", "success") and got["t", 0].publisher is None
    assert {k: r.failure_reason for k, r in got.items() if r.access_status == "failed"} == {("s", 2): "the result has no address", ("s", 3): "no result", ("s", 4): "not fetched", ("s", 6): "not fetched"}
    assert got["s", 2].raw_title is None and got["s", 3].url == "d"


def test_health_of_sources(spark):
    scanned = spark.createDataFrame([("all_failed", 9), ("some", 4), ("none_chosen", 2), ("outside", 1)], "registry_id string, scanned long")
    entries = spark.createDataFrame([("all_failed",)] * 2 + [("some",)] * 3 + [("outside",)], "registry_id string")
    made = spark.createDataFrame([("all_failed", "failed", "x"), ("all_failed", "failed", "y"), ("some", "failed", "x"), ("some", "success", None)], "registry_id string, access_status string, failure_reason string")
    got = {r.registry_id: tuple(r)[1:] for r in articles.health(entries, made, scanned).collect()}
    assert got == {"all_failed": ("failed", 9, 2, 0, 2, "x"), "some": ("success", 4, 3, 1, 1, "x"), "none_chosen": ("success", 2, 0, 0, 0, None), "outside": ("success", 1, 1, 0, 0, None)}


def test_listed_articles(spark):
    items = spark.createDataFrame([("s", i, f"u{i}", n) for i, n in enumerate(["one", "two", None, "gone", "off", ""])], "registry_id string, place int, url string, name string")
    meta = lambda at, **m: "".join(f'<meta name="{k.replace("_", ":", 1)}" content="{v}">' for k, v in {"article_published_time": at, **m}.items())
    pages = [
        ("u0", 1, meta("2026-08-03", og_title="A &amp; B", description="about wolves", article_author="Ann"), None),
        ("u1", 1, meta("2026-08-03", og_description="wolves again"), None),
        ("u2", 1, meta("2026-08-04", description="wolves without a title"), None),
        ("u5", 1, meta("2026-08-04", description="wolves") + "<title> Of &lt;wolves&gt; </title>", None),
        ("u4", 1, meta("2026-08-04", description="sheep"), None),
        ("u0", 2, "", "empty"),
    ]
    got = {r.url: r for r in articles.listed(items, spark.createDataFrame(pages, LANDED.format("body")), *window(), ["wolves"], author="Staff").collect()}
    assert {u: (r.raw_title, r.author, r.failure_reason) for u, r in got.items()} == {
        "u0": ("A & B", ["Ann"], None), "u1": ("two", ["Staff"], None), "u2": ("Untitled article", ["Staff"], None), "u3": (None, None, "not fetched"), "u5": ("Of <wolves>", ["Staff"], None),
    }
    assert articles.listed(items.limit(0), spark.createDataFrame([], LANDED.format("body")), *window()).count() == 0


def test_pdf_texts_go_back_to_their_records(spark):
    kind = "source_id string, canonical_url string, access_status string, raw_title string, raw_text string, raw_excerpt string, content_hash string, rights_scope string, processing_status string, discovery_context string, extra int"
    row = lambda i, url, status="success", context="seen": (str(i), url, status, "T", "old", None, "h", "excerpt", "collected", context, i)
    have = spark.createDataFrame([row(0, "a.pdf"), row(1, "a.pdf", context=None), row(2, "b.PDF#x"), row(3, "c.html"), row(4, "a.pdf", "failed"), row(5, None), row(6, "none.pdf")], kind)
    files = spark.createDataFrame([("a.pdf", bytearray(b"%PDF")), ("b.PDF#x", bytearray(b"zip")), ("c.html", bytearray(b"%PDF")), ("a.pdf", bytearray(b"broken"))], "path string, content binary")
    read = landed.pdf_text(files, lambda b: ["", "key " * 100], ["key"]).withColumnRenamed("path", "url")
    got = {r.source_id: r for r in articles.attach_pdf(have, read).collect()}
    assert len(got) == 7 and {i: r.processing_status for i, r in got.items()} == {"0": "text_extracted", "1": "text_extracted", "2": "pdf_text_needs_review", "3": "collected", "4": "collected", "5": "collected", "6": "pdf_text_needs_review"}
    assert got["0"].raw_text.startswith("[Page 2] key") and got["0"].content_hash not in ("h", None) and got["0"].discovery_context == "seen; pdf_pages:2" and got["1"].discovery_context == "pdf_pages:2"
    assert got["2"].raw_text == "old" and got["2"].content_hash == "h" and got["0"].rights_scope == "primary_source_internal_text" and got["0"].extra == 0


def test_changed_pages_say_what_their_date_means(spark):
    at = dt.datetime(2026, 8, 5)
    entries = spark.createDataFrame([("s", 0, "https://e.org/Blog/a", "A", at), ("s", 1, "https://e.org/blog/tag/b", "B", at), ("s", 2, "https://e.org/about", "C", at), ("s", 3, "https://e.org/blog/old", "D", dt.datetime(2020, 1, 1)), ("s", 4, "https://e.org/blog/u", "E", None)], "registry_id string, place int, url string, title string, modified_at timestamp")
    (r,) = articles.changed_pages(entries, *window(), ["/blog/"], ["/tag/"]).collect()
    assert (r.raw_title, r.rights_scope, r.discovery_context) == ("A", "metadata_only", "date_semantics:last_modified") and "2026-08-05T00:00:00Z" in r.raw_excerpt
