import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltworks.sources import landed, sinks
from siltworks.streaming import inbox

T = lambda s: F.lit(s).cast("timestamp")
START, END = "2026-08-05", "2026-08-12"


def pages(spark, *bodies, url="https://e.org/list/index.html"):
    return spark.createDataFrame([(f"s{i}", url, b) for i, b in enumerate(bodies)], "registry_id string, url string, body string")


RSS = """<rss><channel><item><title><![CDATA[A &amp; <b>B</b>]]></title><link>https://e.org/1</link><description>Video news</description>
<pubDate>Wed, 05 Aug 2026 00:00:00 +0000</pubDate><dc:creator>Ann</dc:creator></item>
<item><title>Old</title><link>https://e.org/2</link><pubDate>Wed, 01 Jul 2026 00:00:00 +0000</pubDate></item>
<entry><title>Atom</title><link href="https://e.org/3"/><summary>x</summary><updated>2026-08-12T00:00:00Z</updated><author><name>Bob</name></author></entry></channel></rss>"""


def test_feeds(spark):
    got = landed.feed_entries(pages(spark, RSS, "<rss>broken"))
    rows = got.orderBy("place").collect()
    assert [(r.title, r.link, r.authors) for r in rows] == [("A & B", "https://e.org/1", ["Ann"]), ("Old", "https://e.org/2", []), ("Atom", "https://e.org/3", ["Bob"])]
    inside = landed.accepted_entries(got, T(START), T(END), [])
    assert {r.title for r in inside.collect()} == {"A & B", "Atom"}
    assert landed.accepted_entries(got, T(START), T(END), ["VIDEO"]).count() == 1
    health = {r.registry_id: (r.status, r.scanned, r.accepted) for r in landed.feed_health(pages(spark, RSS, "<rss>broken"), got, inside).collect()}
    assert health == {"s0": ("success", 3, 2), "s1": ("failed", 0, 0)}
    new = landed.discovered(got, [("https://e.org", "https://m.org")], r"m\.org/[13]", [], 1).collect()
    assert [r.link for r in new] == ["https://m.org/1"]


def test_newsletter(spark):
    card = lambda t, h, d: f'\\"title\\":\\"{t}\\",\\"excerpt\\":\\"ex\\",\\"href\\":\\"{h}\\",\\"date\\":\\"{d}\\"'
    body = card("One", "/n/issue-1", "August 5, 2026") + card("Again", "/n/issue-1", "August 5, 2026") + card("Two", "/n/issue-2", "August 12, 2026") + card("Far", "/n/issue-3", "July 1, 2026")
    cards = landed.issue_cards(pages(spark, body))
    assert {r.issue_url for r in cards.collect()} == {f"https://e.org/n/issue-{i}" for i in (1, 2, 3)}
    html = '<meta property="article:published_time" content="2026-08-05T10:00:00Z"><h1 id="intro">I</h1><p>no</p><h1 id="news">News</h1><h1 id="a">Sec A</h1><p>p1</p><p> </p><p>p2 x</p><p>p3</p><p>p4</p><h1 id="b">Sec B</h1><script></p></script>'
    issues = spark.createDataFrame([("https://e.org/n/issue-1", html), ("https://e.org/n/issue-2", "<p>")], "url string, body string")
    assert [r.paragraphs for r in landed.sections(issues).orderBy("place").collect()] == [["p1", "p2 x", "p3"], []]
    got = {r.url: (r.raw_title, r.raw_excerpt) for r in landed.newsletter_records(cards, issues, T(START), T(END), []).collect()}
    assert got == {"https://e.org/n/issue-1#a": ("Sec A", "p1 p2 x"), "https://e.org/n/issue-1#b": ("Sec B", None), "https://e.org/n/issue-2": ("Two", "ex")}


def test_item_list_and_meta(spark):
    body = '<script type="application/ld+json">{"mainEntity":{"@type":"ItemList","itemListElement":[{"url":"u1","name":"n1"},{"name":"x"},{"url":"u2"}]}}</script><script type="application/ld+json">nope</script>'
    assert [(r.url, r.name) for r in landed.item_list(pages(spark, body)).orderBy("place").collect()] == [("u1", "n1"), ("u2", None)]
    df = spark.createDataFrame([('<meta content="D &amp; E" name="description">',)], "b string")
    assert df.select(landed.meta_tag(F.col("b"), "og:description", "description").alias("m")).first().m == "D & E"


@pytest.mark.parametrize(
    "page, title, text",
    [
        ("<META NAME=description CONTENT=plain><meta content='a \"b\"' property='og:title'/>", 'a "b"', "plain"),
        ('<meta content="say name=description > 2" name="og:title"><meta name="description" content="x&lt;y">', "say name=description > 2", "x<y"),
        ('<meta name="og:title" content=""><meta name="og:title" content="later"><meta name="og:title" content="last">', "later", None),
        ('<meta charset="utf-8"><metadata name="og:title" content="no"><meta property="" name="description" content="d">', None, "d"),
        ("", None, None),
        (None, None, None),
    ],
)
def test_meta_elements_as_pages_write_them(spark, page, title, text):
    df = spark.createDataFrame([(page,)], "b string")
    assert tuple(df.select(landed.meta_tag(F.col("b"), "og:title").alias("t"), landed.meta_tag(F.col("b"), "description").alias("d")).first()) == (title, text)


def test_linked_data_with_character_references(spark):
    body = '<script type="application/ld+json">{&quot;mainEntity&quot;:{"@type":"ItemList","itemListElement":[{"url":"u?a=1&amp;b=2","name":"R &amp; D"}]}}</script>'
    bare = '<script type="application/ld+json">{"mainEntity":{"@type":"ItemList","itemListElement":[{"url":"v"}]}}</script>'
    assert [(r.url, r.name) for r in landed.item_list(pages(spark, body + bare)).orderBy("place").collect()] == [("u?a=1&b=2", "R & D"), ("v", None)]
    assert landed.item_list(pages(spark, "<p>")).count() == 0


def test_disclosures(spark):
    body = '<a href="/r/1.pdf">Quarterly results of 2026</a> <i>Aug 5, 2026</i>' + "x" * 800 + '<p>2026.08.12</p><a href="r2.pdf">Annual report for 2026</a>' + "y" * 800 + '<a href="z">short</a> Aug 6, 2026'
    got = landed.dated_links(pages(spark, body))
    rows = got.orderBy("place").collect()
    assert [(r.url, r.published_at.date()) for r in rows] == [("https://e.org/r/1.pdf", dt.date(2026, 8, 5)), ("https://e.org/list/r2.pdf", dt.date(2026, 8, 12))]
    assert [r.place for r in landed.disclosures(got, T(START), T(END), ["results", "report"], ["annual"]).collect()] == [0]
    json = '{"documentId":"77","documentPublishTime":1785888000000,"documentTitle":"A \\"q\\" \\u00e9"}'
    r = landed.embedded_documents(pages(spark, json)).first()
    assert (r.title, r.url) == ('A "q" é', "https://e.org/en-US/document-77") and r.published_at.date() == dt.date(2026, 8, 5)
    tries = spark.createDataFrame([("s", 1, "u1", None), ("s", 2, "u2", "b"), ("t", 1, "u3", None)], "registry_id string, attempt int, url string, body string")
    assert {(r.registry_id, r.url, r.status) for r in landed.fallback_page(tries).collect()} == {("s", "u2", "success"), ("t", None, "failed")}


def test_announcements(spark):
    row = '<tr><td>05/08/2026 07:30</td><td>00700</td><td><div class="headline">Results &amp; more</div><div class="doc-link"><a href="/d.pdf">Interim</a></div></td></tr>'
    got = landed.announcements(pages(spark, "<table><tr><th>x</th></tr>" + row + row.replace("00700", "00001") + "</table>"), ["00700"]).collect()
    assert len(got) == 1 and got[0].category == "Results & more" and got[0].published_at == dt.datetime(2026, 8, 4, 23, 30)
    with pytest.raises(ValueError):
        landed.require_rows(landed.announcements(pages(spark, "")), "rows")


def test_filings_and_sitemap(spark):
    body = '{"filings":{"recent":{"accessionNumber":["1-2","3-4"],"filingDate":["2026-08-05","2026-08-06"],"acceptanceDateTime":["2026-08-05T01:00:00.000Z",""],"form":["10-Q","8-K"],"primaryDocument":["a.htm","b.htm"],"primaryDocDescription":["","8-K note","extra"]}}}'
    got = landed.filings(spark.createDataFrame([("0012", body)], "cik string, body string"), ["10-Q", "8-K"]).orderBy("place").collect()
    assert [(r.title, r.url.split("/")[-3:]) for r in got] == [("10-Q filing", ["12", "12", "a.htm"]), ("8-K note", ["12", "34", "b.htm"])]
    assert got[1].published_at == dt.datetime(2026, 8, 6)
    xml = "<urlset><url><loc>https://e.org/reports/big-year_2026/</loc><lastmod>2026-08-05</lastmod></url><url><loc>https://e.org/x</loc></url></urlset>"
    got = landed.sitemap(pages(spark, xml)).collect()
    assert [(r.title, r.modified_at.date()) for r in got] == [("Big Year 2026", dt.date(2026, 8, 5))]


def test_api_and_accounts(spark):
    body = '{"list":[{"mp_id":"m1","mp_name":"N","title":"T","url":"u","publish_time":1785888000},{"mp_id":"m2","url":"v","publish_time":1785888000},{"mp_id":"m1","url":" ","publish_time":1785888000}]}'
    p = spark.createDataFrame([("s", 0, body), ("s", 3, body)], "registry_id string, offset int, body string")
    allowed = spark.createDataFrame([("m1",)], "mp_id string")
    assert landed.api_articles(p, allowed, T(START), T(END)).count() == 2
    assert landed.api_articles(p, allowed, T(START), T(END), most=3).count() == 1
    assert landed.api_records(landed.api_articles(p, allowed, T(START), T(END))).first().publisher == "N"
    names = [(f"a{i}", "P0" if i == 4 else None) for i in range(5)]
    a = spark.createDataFrame(names, "account_name string, priority string")
    order = ["a4", "a0", "a1", "a2", "a3"]
    for day in (dt.date(2026, 8, 3), dt.date(2026, 8, 6)):
        start = (day.toordinal() - day.weekday() + (2 if day.weekday() >= 3 else 0)) % 5
        assert {r.account_name for r in landed.rotating_subset(a, day, 2).collect()} == set((order + order)[start : start + 2])
    found = spark.createDataFrame([("N", "1", "N", 0, "x", 1), ("N", "2", "N", 1, None, 0), ("N", "3", "NN", 9, "x", 9)], "name string, id string, nickname string, verify_status int, alias string, service_type int")
    assert landed.exact_match(found).first().id == "2"


def test_extracted_and_inbox(spark):
    p = spark.createDataFrame([("s", '{"title":"T","url":"u","content":"c","published_at":"2026-08-06T00:00:00Z"}'), ("s", '{"title":"T"}')], "registry_id string, payload string")
    assert landed.extracted_articles(p, T(START), T(END)).count() == 1 == landed.extracted_articles(p).count()
    at = dt.datetime(2026, 8, 12)
    rows = [("u", at, True), ("v", None, None), ("w", at, False), ("", at, True), ("x", at + dt.timedelta(seconds=1), True)]
    assert {r.url for r in landed.inbox(spark.createDataFrame(rows, "url string, discovered_at timestamp, enabled boolean"), T(START), T(END)).collect()} == {"u", "v"}


def test_pdf_isolates_failures(spark):
    files = spark.createDataFrame([("a", bytearray(b"%PDF x")), ("b", bytearray(b"no")), ("c", bytearray(b"%PDF" + b"y" * 50))], "path string, content binary")
    got = {r.path: r for r in landed.pdf_text(files, lambda b: ["", "key " * 100], ["key"], most=40).collect()}
    assert got["a"].status == "success" and got["a"].full_text.startswith("[Page 2] key") and got["a"].excerpt.startswith("[Page 2]")
    assert got["b"].status == "failed" and "not a PDF" in got["b"].reason and "larger" in got["c"].reason


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b\nc", "s1")], "n int, t string, registry_id string")
    for _ in range(2):
        sinks.write_run(df, str(tmp_path / "runs"), "r1")
        sinks.append_log(df, str(tmp_path / "log"))
    sinks.write_bronze(df, str(tmp_path / "bronze"))
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 1 and spark.read.json(str(tmp_path / "log")).count() == 2
    assert spark.read.parquet(str(tmp_path / "bronze")).filter("registry_id = 's1'").count() == 1
    assert "| 1 | a\\|b c | s1 |" in sinks.markdown_table(df, "T")
    assert sinks.embed_json("x<!--b-->old<!--e-->y", {"a": "</script>"}, "<!--b-->", "<!--e-->") == 'x<!--b-->{"a": "\\u003c/script>"}<!--e-->y'
    with pytest.raises(ValueError):
        sinks.embed_json("none", {}, "b", "e")
    assert "run_1" in sinks.review_instructions("run_1", 3)


def test_streaming_inbox(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    line = '{{"url":"{}","discovered_at":"2026-08-06T00:0{}:00Z","discovered_by":"me"}}'
    (src / "1.json").write_text("\n".join([line.format("https://E.org/a?utm_x=1", 1), line.format("https://e.org/a", 2), line.format("https://e.org/b", 3)]))
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for extra in (None, line.format("https://e.org/a#x", 5)):
        if extra:
            (src / "2.json").write_text(extra)
        inbox.write(inbox.once(inbox.read(spark, str(src))), out, check).awaitTermination(120)
    assert sorted(r.canonical_url for r in spark.read.parquet(out).collect()) == ["https://e.org/a", "https://e.org/b"]


def test_api_pages_end_at_the_first_gap(spark):
    def body(items, total):
        return '{"list":[' + ",".join(['{"title":"t"}'] * items) + f'],"total":{total}}}'

    rows = [("a", 0, body(2, 5)), ("a", 2, body(2, 5)), ("a", 4, body(1, 5)), ("a", 5, body(0, 5))]  # to the end; an empty page behind it
    rows += [("b", 0, body(2, 9)), ("b", 0, body(1, 9)), ("b", 4, body(2, 9)), ("b", 6, body(2, 9))]  # a gap at 2; one offset twice
    rows += [("c", 2, body(2, 4)), ("d", 0, "not json"), ("e", 0, None), ("f", 0, body(0, 0))]
    pages = spark.createDataFrame(rows, "registry_id string, offset int, body string")
    got = {(r.registry_id, r.offset): r.reached for r in landed.api_pages(pages).collect()}
    assert got == {("a", 0): True, ("a", 2): True, ("a", 4): True, ("a", 5): False, ("b", 0): True, ("b", 4): False, ("b", 6): False, ("c", 2): False, ("d", 0): True, ("e", 0): True, ("f", 0): True}
    feeds = spark.createDataFrame([(k, k, "N") for k in "abcdfg"], "registry_id string, mp_id string, mp_name string")
    wanted = spark.createDataFrame([(k, n, on) for k in "abcdefg" for n, on in (("N", None), ("M", True), ("off", False))], "registry_id string, account_name string, enabled boolean")
    logins = spark.createDataFrame([(k, '{"login_status":true}') for k in "abcdf"] + [("e", "{}"), ("g", None)], "registry_id string, body string")
    health = {r.registry_id: (r.state, r.status, r.scanned, r.available, r.accepted, r.configured, r.matched, r.missing) for r in landed.api_health(pages, feeds, wanted, logins, pages.select("registry_id").limit(0)).collect()}
    assert health["a"] == ("complete", "success", 5, 5, 0, 2, 1, ["M"]) and health["b"][:4] == ("gap", "success", 2, 9)
    assert health["c"][:2] == ("gap", "failed") and health["d"][:2] == health["f"][:2] == ("sync_pending", "failed") and health["e"][:2] == health["g"][:2] == ("no_login", "failed")


def test_upsert_of_texts_does_not_multiply_rows(spark):
    columns = "source_id string, raw_title string, raw_text string, raw_excerpt string, content_hash string, rights_scope string, access_status string, failure_reason string, attempt int"
    have = spark.createDataFrame([(k, "T", t, None, "old", "excerpt", "success", None, 9) for k, t in (("a", None), ("b", "own"), ("c", None), ("d", "x"), (None, "y"))], columns)
    found = spark.createDataFrame([("a", 1, "first", None), ("a", 2, "second", None), ("a", 3, " ", "late"), ("b", 1, None, "HTTP 500"), ("c", 1, "", None), (None, 1, "z", None), ("zz", 1, "z", None)], "source_id string, attempt int, text string, reason string")
    got = landed.upsert_texts(have, found)
    assert got.columns == have.columns
    rows = {r.source_id: (r.raw_text, r.access_status, r.failure_reason, r.content_hash == "old", r.attempt) for r in got.collect()}
    assert got.count() == 5 and rows == {"a": ("second", "success", None, False, 9), "b": ("own", "success", "HTTP 500", True, 9), "c": (None, "failed", "no text", True, 9), "d": ("x", "success", None, True, 9), None: ("y", "success", None, True, 9)}


def test_search_stops_at_the_first_older_entry(spark):
    at = lambda d: dt.datetime(2026, 8, d)
    rows = [("s", 0, 0, at(14)), ("s", 0, 1, at(10)), ("s", 1, 0, None), ("s", 1, 1, at(6)), ("s", 1, 2, at(1)), ("s", 2, 0, at(9)), ("t", 0, 0, at(7)), ("t", 0, 1, at(8)), (None, 0, 0, at(8))]
    entries = spark.createDataFrame(rows, "registry_id string, page int, place int, published_at timestamp")
    got = {(r.registry_id, r.page, r.place): r.scanned for r in landed.search_results(entries, T(START), T(END)).collect()}
    assert got == {("s", 0, 1): 5, ("s", 1, 1): 5, ("t", 0, 0): 2, ("t", 0, 1): 2, (None, 0, 0): 1}
    assert {r.place for r in landed.search_results(entries.filter("registry_id = 't'"), T(START), T(END), most=1).collect()} == {0}
    said = spark.range(1).select(landed.search_text(F.array(F.lit("cs.CV"), F.lit("cs.RO")), F.array(F.lit("world model"))).alias("q")).first().q
    assert said == '(cat:cs.CV OR cat:cs.RO) AND (all:"world model")'


def test_no_page_is_repeated_for_its_rows(spark):
    pages = spark.createDataFrame([("r", "https://n.org/", '<a href="/x">A long enough label</a> 2024.1.2')], "registry_id string, url string, body string")
    rows = landed.dated_links(pages)
    assert [(r.place, r.url, str(r.published_at.date())) for r in rows.collect()] == [(0, "https://n.org/x", "2024-01-02")]
    for made in (rows, landed.sections(pages), landed.announcements(pages), landed.embedded_documents(pages)):
        assert "explode(" not in made._jdf.queryExecution().optimizedPlan().toString()
