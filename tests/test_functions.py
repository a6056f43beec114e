import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltworks.functions import ids, records, scoring, text, times, urls
from siltworks.operators.cluster import title_similarity


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "url, want",
    [
        ("HTTPS://Example.COM/a/b/?utm_Source=x&B=2&ref=q&c=#top", "https://example.com/a/b?B=2&c="),
        ("https://example.com", "https://example.com/"),
        ("https://example.com///", "https://example.com/"),
        ("http://www.arxiv.org/abs/1234.5678v3", "https://arxiv.org/abs/1234.5678"),
        ("https://www.deeplearning.ai/the-batch/issue-9/#news", "https://www.deeplearning.ai/the-batch/issue-9#news"),
        ("  https://e.org/p?gclid=1&fbclid=2&spm=3&source=4 ", "https://e.org/p"),
        (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    assert one(spark, url, urls.canonicalize_url) == want
    if want:
        assert one(spark, want, urls.canonicalize_url) == want


def test_url_helpers(spark):
    assert one(spark, "https://e.org/x", urls.valid_url) and not one(spark, "ftp://e.org", urls.valid_url) and not one(spark, None, urls.valid_url)
    assert one(spark, "--Hello, World! 2--", urls.slug) == "hello_world_2"
    assert len(one(spark, "a" * 99, urls.slug)) == 36
    assert one(spark, "https://blog.e.org/x", lambda u: urls.source_label(u, [("blog.", "Blog"), ("e.org", "E")])) == "Blog"
    assert one(spark, "http://m.e.org", lambda u: urls.rewrite_url(u, [("http:", "https:"), ("//m.", "//www.")])) == "https://www.e.org"


def test_clean_html(spark):
    page = "<style>p{}</style><p>a b　 c</p><SCRIPT>x='</p>'</SCRIPT> <b>d"
    assert one(spark, page, text.clean_html) == "a b c d"
    assert one(spark, "<p> </p>", text.clean_html) is None and one(spark, None, text.clean_html) is None
    assert one(spark, "标题", text.language_hint) == "zh-CN" and one(spark, "t", text.language_hint) == "und"


def test_titles(spark):
    assert one(spark, "The $GPT-4 of  Tools", text.normalize_title) == "the gpt 4 of tools"
    assert sorted(one(spark, "The gpt tools of a gpt x", text.tokens)) == ["gpt", "tools"]
    assert one(spark, "Retrieval", lambda c: text.matches(c, ["eval", "x"])) == ["eval"]
    assert one(spark, "Retrieval", lambda c: text.matches(c, ["eval"], mode="word")) == []
    assert title_similarity("abc def", "abc def") == 1.0
    assert title_similarity("abcdefghij", "abcdefghik") == pytest.approx(0.9)
    row = spark.createDataFrame([("Alpha Beta Gamma", "alpha beta gamma delta")], "a string, b string")
    assert row.select(text.similarity(F.col("a"), F.col("b")).alias("s")).first().s == pytest.approx(32 / 38)


@pytest.mark.parametrize("value", ["2026.8.5", "2026/08/05", "2026-8-5", "August 5, 2026", "Aug 5, 2026"])
def test_publication_dates(spark, value):
    assert one(spark, value, lambda c: F.to_date(times.parse_publication_date(c))) == dt.date(2026, 8, 5)


def test_times(spark):
    as_iso = lambda f: lambda c: times.iso(f(c))
    assert one(spark, "2026-08-05T10:00:00+02:00", as_iso(times.parse_iso_datetime)) == "2026-08-05T08:00:00Z"
    assert one(spark, "Wed, 05 Aug 2026 10:00:00 +0200", as_iso(times.parse_iso_datetime)) == "2026-08-05T08:00:00Z"
    assert one(spark, "soon", times.parse_iso_datetime) is None and one(spark, "x", times.unix_datetime) is None
    assert one(spark, "1700000000", as_iso(times.unix_datetime)) == one(spark, "1700000000000", as_iso(times.unix_datetime)) == "2023-11-14T22:13:20Z"
    assert one(spark, dt.date(2027, 1, 1), ids.issue_id, "date") == "issue_2026_w53"


def test_source_record(spark):
    rows = spark.createDataFrame([("https://E.org/a?utm_x=1", " ", None, "failed", "no"), ("https://e.org/b", "T", "标题", "success", None)], "source_url string, raw_title string, raw_excerpt string, access_status string, failure_reason string")
    got = records.to_source_record(rows).orderBy("canonical_url").collect()
    assert list(got[0].asDict()) == list(records.SOURCE_RECORD) and len(records.SOURCE_RECORD) == 24
    assert got[0].raw_title == "Untitled source" and got[0].processing_status == "needs_review" and got[0].source_id.startswith("src_")
    assert got[1].language == "zh-CN" and got[1].processing_status == "collected"


def test_article_payload(spark):
    flat = '{"title":"T","url":"u","author":"A","content":"C","published_at":"2026-08-05T00:00:00Z"}'
    nested = '{"title":"T","news_url":"n","meta_info":{"author_name":"A","publish_time":"2026-08-05 00:00:00"},"texts":["a","b"]}'
    a, b = (one(spark, x, records.article_payload) for x in (flat, nested))
    assert (a.url, a.body, a.author, a.rights_scope) == ("u", "C", ["A"], "internal_text")
    assert (b.url, b.body, b.author) == ("n", "a\nb", ["A"]) and b.published_at is not None


def brute_excerpt(pages, terms, most=6000):
    ranked = []
    for n, p in enumerate(pages, 1):
        hits = [(len(t.split()), p.lower().find(t.lower())) for t in terms if p.lower().find(t.lower()) >= 0]
        if hits:
            ranked.append((-sum(w for w, _ in hits), -len(hits), n, sorted(hits, key=lambda h: (-h[0], h[1]))[0][1], p))
    ranked = sorted(ranked) or [(0, 0, n, 0, p) for n, p in enumerate(pages[:2], 1) if p]
    return "\n\n".join(f"[Page {n}] {p[max(0, at - 240) : max(0, at - 240) + 1500]}" for _, _, n, at, p in ranked[:5])[:most]


def test_focused_excerpt(spark):
    for pages in (["", "x" * 3000 + " key term", "other key", "key term key"], ["none", "", "three"], ["a key"] * 9, []):
        assert one(spark, pages, lambda c: records.focused_excerpt(c, ["key", "key term"]), "array<string>") == brute_excerpt(pages, ["key", "key term"])


def test_nearby_date(spark):
    page = "<p>Jan 3, 2026</p><a href='x'>label</a><i>2026-02-30 Sept 4, 2026</i>"
    start, end = page.index("<a"), page.index("</a>") + 4
    got = one(spark, page, lambda c: F.to_date(records.nearby_date(c, F.lit(start), F.lit(end))))
    assert got == dt.date(2026, 9, 4)
    assert one(spark, page[:end], lambda c: F.to_date(records.nearby_date(c, F.lit(start), F.lit(end)))) == dt.date(2026, 1, 3)


RULES = scoring.Rules(
    routes={"r.a": {"alpha": 8, "alpine": 4}, "r.b": {"beta": 6}, "r.c": {"gamma": 5}},
    precedence=("r.b", "r.a", "r.c"),
    markers={"r.c": ("special",)},
    hard_terms=("hiring",),
    soft_terms={"minor": -2},
    boosts={"launch": 3, "open": 1},
    types={"t.x": ("paper",), "t.y": ("launch",)},
    type_precedence=("t.x", "t.y"),
    source_boosts={"paper_report": {"t.x": 1}},
    watch_prefix="Watch-",
    watch_route="r.b",
    maintenance_titles=("update readme md",),
)


def score(spark, **row):
    base = {"title": "", "excerpt": None, "source_type": "blog", "name": None, "context": None} | row
    df = spark.createDataFrame([tuple(base.values())], "title string, excerpt string, source_type string, name string, context string")
    return scoring.score_records(df, RULES, source_name=F.col("name"), context=F.col("context")).first()


def test_scoring(spark):
    r = score(spark, title="Alpha alpine", excerpt="beta minor launch open")
    assert (r.primary_route, r.secondary_routes) == ("r.a", ["r.b"])
    assert r.score == (8 + 1) + 1 + 3 - 2
    assert score(spark, title="Beta alpha").primary_route == "r.a"
    assert score(spark, title="special alpha").primary_route == "r.c"
    assert score(spark, title="Update README.md", source_type="paper_report").score == 2 - 8
    w = score(spark, title="x", name="Watch-1")
    assert (w.primary_route, w.score) == ("r.b", 8 + 4)
    assert score(spark, title="x", context="alpha").primary_route is None
    f = score(spark, title="x", context="alpha", source_type="financial_report")
    assert (f.primary_route, f.score) == ("r.a", 1 + 2)
    assert score(spark, title="Hiring alpha").hard == ["hiring"]
    n = score(spark, title=None)
    assert n.primary_route is None and n.score == 0 and n.kind == "t.x"
