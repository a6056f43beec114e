"""Main text of web pages: page structure and suffix arrays of each host's pages.

A page is read into blocks with a role: article (inside an ``article`` element), main
(inside a ``main`` element only), chrome (menus, headers, footers, sidebars, forms and what
is hidden, by element), or body (the rest).  Chrome goes.  A container with a class, id or
role that is, as a whole, one of ``CHROME_WORDS`` or made of them and ``PLACE_WORDS`` marks
its blocks: notices, adverts, sharing, reader comments.  Marked blocks go as well, unless they are what there is: a
wrapper of the article, the only article, or nearly all of an article's or page's words.
Names that merely contain such a word say nothing, nor do those of paragraphs, headings,
list items and inline elements, so no word of an article goes for its class.  End tags
that HTML lets one leave out are implied.  The token
streams of a host's other blocks are concatenated and their suffixes sorted by prefix
doubling; suffixes that share ``MIN_TOKENS`` tokens are neighbours, and the pages among
them are the support of that run.  A token lies inside a repeated run of ``MIN_TOKENS``
or more exactly if one of the runs of ``MIN_TOKENS`` over it is repeated, so suffixes
need no longer order than that.

* A page with article or main blocks gives these, also where other pages carry the same
  article or a passage of it.  A main block of fewer than ``PASSAGE`` words that is covered
  by runs on ``SUPPORT`` or more pages is boilerplate and goes (share lines, notices and
  adverts that no element or class tells), as long as most of the text around it is the
  page's own.  Article blocks stay: lines that many articles share are part of them.
* A page without gives its body blocks less the runs on several pages; the unique runs
  stay.  If hardly anything of it is unique the page is a copy and keeps its body.

A host with many pages is dealt by page hash into groups of about ``GROUP_PAGES`` pages
with an array each; where some page of the host has blocks to decide on, the supports of equal
runs of all blocks, known by a 64-bit hash, are then added over the groups by Spark and joined back.  A page's text is therefore the same however
its host is dealt, and no group grows with its host.

Defined results: null or empty html gives an empty text; a page without url belongs
to the nameless host; repeated rows are separate pages, and pages that share an id
count as one page for repeats, those without an id each as one; ids may have any type.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.textbytes import mix64
from siltworks.llm.workspace import Tables
from siltworks.sources.pages import BLOCKS, HOLDS, STARTS, TABLE, WALLS

GROUP_PAGES = 128
MIN_TOKENS = 6
PASSAGE = 50
SUPPORT = 3
OWN_SHARE = 0.5
MAX_BROADCAST_HOSTS = 100_000
UNIQUE_SHARE = 0.1

ARTICLE, BODY, CHROME, MAIN = 0, 1, 2, 3
#: Added to the role of blocks that a class marks.
MARKED = 8
#: A marked part of an article stays if the rest has fewer words than this and than a tenth of the part.
TITLE_WORDS = 50

#: No alternative looks beyond the next "<" except inside quotes, so a page is read in linear time.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^<>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+)>", re.S)
LABEL = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
RAW = frozenset("script style noscript template svg math iframe object canvas audio video textarea title head".split())
ALWAYS_CHROME = frozenset("nav footer aside form menu dialog button select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split()
)
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted promotion recommended related respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Words that a compound name may add to one of these: ``comment-list``, but not ``has-sidebar``.
PLACE_WORDS = frozenset("area bar block box button buttons container item items link links list panel row section site slot unit wrap wrapper".split())
#: Elements that a class can mark; ``p``, headings, list items and inline elements never are.
CONTAINERS = frozenset("article aside center details div dl fieldset footer header menu nav ol section table ul".split())


def _hidden(attributes: str) -> bool:
    return bool(attributes) and bool(HIDDEN.search(attributes))


def _marked(attributes: str) -> bool:
    """A class, id or role is one of the words, or made of such words and those of places."""
    names = [re.split("[-_]+", w) for m in LABEL.finditer(attributes) for w in (m[1] or m[2] or m[3] or "").lower().split()] if attributes else []
    return any(not CHROME_WORDS.isdisjoint(parts) and all(x in CHROME_WORDS or x in PLACE_WORDS for x in parts) for parts in names)


def _role(name: str, attributes: str, role: int) -> int:
    """The role inside an element that stands where ``role`` holds."""
    base, marked = role & ~MARKED, role & MARKED
    if base == CHROME:
        return CHROME
    if name in ALWAYS_CHROME or name == "header" and base == BODY or name not in ("body", "html") and _hidden(attributes):
        return CHROME
    if name in ("article", "main") and base != ARTICLE:
        base = ARTICLE if name == "article" else MAIN
    if name in CONTAINERS and not marked and _marked(attributes):
        marked = MARKED
    return base | marked


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(role, text) of the page's blocks in page order, white space already folded."""
    if not page:
        return []
    found: list[tuple[int, str]] = []
    text: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("", BODY)]
    opened: Counter[str] = Counter()

    def close() -> None:
        """Ends a block; what is hidden inside it is left out."""
        seen = [(r, t) for r, t in text if r != CHROME]
        folded = " ".join(html.unescape("".join(t for _, t in seen)).split())
        if folded:
            # White space between elements may carry the role of what holds them.
            found.append((next(r for r, t in seen if not t.isspace()), folded))
        text.clear()

    def innermost(name: str, walls: frozenset[str]) -> int | None:
        if opened[name]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    return i
                if stack[i][0] in walls:
                    return None
        return None

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            name, _ = stack.pop()
            opened[name] -= 1
            if name in BLOCK:
                close()

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if not m:
            text.append((stack[-1][1], page[at:]))
            break
        if m.start() > at:
            text.append((stack[-1][1], page[at : m.start()]))
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if name in BLOCK:
                close()
            walls = frozenset() if name in ("table", "object") else WALLS - TABLE if name in TABLE else WALLS
            if (i := innermost(name, walls - {name})) is not None:
                pop_to(i)
            continue
        attributes = m[3] or m[6] or ""
        if name in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{name}\s*>|<body\b" if name == "head" else rf"</{name}\s*>", re.I).search(page, at)
            at = (end.start() if end and end[0][1] != "/" else end.end()) if end else n
            continue
        if name in BLOCKS and (i := innermost("p", WALLS)) is not None:
            pop_to(i)
        for ended in STARTS.get(name, ()):
            walls = WALLS - {"td", "th"} if ended in TABLE else WALLS | HOLDS.get(ended, frozenset())
            if (i := innermost(ended, walls - {ended})) is not None:
                pop_to(i)
        if name == "br" or name in ("td", "th", "img"):
            text.append((stack[-1][1], " "))
        if name in VOID:
            if name == "hr":
                close()
            continue
        if name in BLOCK:
            close()
        stack.append((name, _role(name, attributes, stack[-1][1])))
        opened[name] += 1
    close()
    return chosen(found)


def chosen(found: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The blocks without those that their class takes away; of marked blocks that stay the mark is gone."""
    size: Counter[int] = Counter()
    for role, t in found:
        size[role] += 1 + t.count(" ")
    plain, marked = size[ARTICLE] + size[MAIN], size[ARTICLE | MARKED] + size[MAIN | MARKED]
    if plain or marked:
        stays = plain < TITLE_WORDS and 10 * plain < marked
    else:
        stays = not size[BODY]
    return [(role & ~MARKED if role != CHROME else CHROME, t) for role, t in found if stays or not role & MARKED or role == CHROME]


def suffix_order(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, ranks) of the stream, ordered by at least ``depth`` first tokens."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    k = 1
    while k < depth and len(tokens):
        key = (rank + 1) << 32
        key[:-k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.empty(len(rank), np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = fresh
        k *= 2
        if rank.max(initial=0) == len(rank) - 1:
            break
    return order, rank


def common_prefix(tokens: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length, up to ``most``, of the prefix each suffix shares with the one before it in order."""
    lcp = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    n = len(tokens)
    for k in range(most):
        a, b = order[live] + k, order[live - 1] + k
        ok = (a < n) & (b < n)
        ok[ok] = tokens[a[ok]] == tokens[b[ok]]
        live = live[ok]
        lcp[live] += 1
    return lcp


def supports(tokens: np.ndarray, page: np.ndarray, least: int = MIN_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of one occurrence, pages) of each different run of ``least`` tokens, and the run that starts at each token or -1.

    Negative tokens end blocks and are in no run.
    """
    n = len(tokens)
    run_at = np.full(n, -1)
    if n < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), run_at
    order, _ = suffix_order(tokens, least)
    lcp = common_prefix(tokens, order, least)
    # Suffixes that share their first ``least`` tokens are neighbours in the array.
    group = np.cumsum(lcp < least) - 1
    ends = np.concatenate([[0], np.cumsum(tokens < 0)])
    upto = np.minimum(order + least, n)
    whole = (order + least <= n) & (ends[upto] == ends[order])
    order, group = order[whole], np.unique(group[whole], return_inverse=True)[1]
    run_at[order] = group
    pairs = np.unique(group * (int(page.max()) + 1) + page[order]) // (int(page.max()) + 1)
    start = np.zeros(group.max(initial=-1) + 1, np.int64)
    start[group] = order
    return start, np.bincount(pairs, minlength=len(start)), run_at


def covered(run_at: np.ndarray, marked: np.ndarray, least: int = MIN_TOKENS) -> np.ndarray:
    """True at the tokens of marked runs."""
    reach = np.zeros(len(run_at) + least + 1, np.int64)
    hit = np.flatnonzero((run_at >= 0) & np.append(marked, False)[run_at])
    np.add.at(reach, hit, 1)
    np.add.at(reach, hit + least, -1)
    return np.cumsum(reach)[: len(run_at)] > 0


class Streams:
    """The token streams of the pages of one group, one after another."""

    def __init__(self, pages: list[tuple[object, list[tuple[int, str]]]]):
        pages = [(i if k is None else (k,), found) for i, (k, found) in enumerate(pages)]
        ids = {k: i for i, k in enumerate(dict.fromkeys(k for k, _ in pages))}
        vocabulary: dict[str, int] = {}
        stream: list[int] = []
        page: list[int] = []
        self.words = [[t.split(" ") for _, t in found] for _, found in pages]
        self.starts: list[list[int]] = []
        mark = 0
        for (k, _), own in zip(pages, self.words):
            self.starts.append([])
            for w in own:
                self.starts[-1].append(len(stream))
                stream += [vocabulary.setdefault(x, len(vocabulary)) for x in w]
                mark -= 1
                stream.append(mark)
                page += [ids[k]] * (len(w) + 1)
        self.tokens = np.array(stream, np.int64)
        self.start, self.pages, self.run_at = supports(self.tokens, np.array(page, np.int64))
        self.hashes = np.array([xxhash.xxh64_intdigest(x) for x in vocabulary], np.uint64)

    def digests(self) -> np.ndarray:
        """A 64-bit hash of each different run, the same in every group."""
        out = np.zeros(len(self.start), np.uint64)
        for k in range(MIN_TOKENS if len(out) else 0):
            out = out * np.uint64(0x9E3779B97F4A7C15) + self.hashes[self.tokens[self.start + k]]
        return mix64(out).view(np.int64)


def page_texts(pages: list[tuple[object, list[tuple[int, str]]]], elsewhere: dict[int, int] | None = None) -> list[str]:
    """The main text of each page of one group, given its blocks.

    ``elsewhere`` has, by digest, the pages of other groups that hold a run.
    """
    streams = Streams(pages)
    pages_of = streams.pages
    if elsewhere:
        pages_of = pages_of + np.array([elsewhere.get(d, 0) for d in streams.digests().tolist()], np.int64)
    twice, often = covered(streams.run_at, pages_of > 1), covered(streams.run_at, pages_of >= SUPPORT)
    out = []
    for i, (_, found) in enumerate(pages):
        spans = [(s, s + len(w)) for s, w in zip(streams.starts[i], streams.words[i])]
        article = [k for k, (role, _) in enumerate(found) if role in (ARTICLE, MAIN)]
        if article:
            total = sum(spans[k][1] - spans[k][0] for k in article)
            line = [k for k in article if found[k][0] == MAIN and spans[k][1] - spans[k][0] < PASSAGE and often[slice(*spans[k])].all()]
            own = sum(int((~twice[slice(*spans[k])]).sum()) for k in article)
            around = total - sum(spans[k][1] - spans[k][0] for k in line)
            drop = set(line) if own > OWN_SHARE * around else set()
            out.append("\n".join(found[k][1] for k in article if k not in drop))
            continue
        kept, whole, unique, total = [], [], 0, 0
        for (role, t), w, (a, b) in zip(found, streams.words[i], spans):
            if role != BODY:
                continue
            bare = ~twice[a:b]
            whole.append(t)
            total += len(w)
            unique += int(bare.sum())
            rest = " ".join(x for x, ok in zip(w, bare) if ok)
            if rest:
                kept.append(rest)
        out.append("\n".join(kept if unique >= UNIQUE_SHARE * total else whole))
    return out


def useful(found: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The blocks that can be text or tell what is boilerplate in text."""
    return [(role, t) for role, t in found if role != CHROME]


def undecided(found: list[tuple[int, str]]) -> bool:
    """Whether the page has blocks that go or stay by the runs of other pages."""
    article = any(role in (ARTICLE, MAIN) for role, _ in found)
    return any(t.count(" ") < PASSAGE - 1 if role == MAIN else role == BODY and not article for role, t in found)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    large = pages.groupBy(host.alias("host")).agg(F.count("*").alias("n")).filter(F.col("n") > GROUP_PAGES).select("host", F.ceil(F.col("n") / GROUP_PAGES).alias("parts"))
    large = Tables(pages.sparkSession, "hosts").keep(large, "large")
    rows = pages.select(F.col(id_col).alias("k"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    if large.limit(MAX_BROADCAST_HOSTS + 1).count() <= MAX_BROADCAST_HOSTS:
        large = F.broadcast(large)
    rows = rows.join(large, "host", "left").withColumn("part", F.pmod(F.when(F.col("k").isNull(), F.xxhash64("url", "html")).otherwise(F.xxhash64(F.col("k").cast("string"))), F.coalesce("parts", F.lit(1))))
    kind = pa.list_(pa.struct([("role", pa.int8()), ("text", pa.string())]))
    id_type = rows.schema["k"].dataType.simpleString()

    def parser(which):
        def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 500):
                    part = batch.slice(a, 500)
                    found = [[{"role": r, "text": t} for r, t in which(blocks(x.as_py()))] for x in part.column(2)]
                    yield pa.record_batch([part.column(0), part.column(1), pa.array(found, kind), part.column(3), part.column(4)], names=["k", "url", "blocks", "host", "part"])

        return parse

    def hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The hosts of pages that are undecided, once a batch."""
        for batch in batches:
            told = {h for x, h in zip(batch.column(0), batch.column(1).to_pylist()) if undecided(blocks(x.as_py()))}
            yield pa.record_batch([pa.array(sorted(told), pa.string())], names=["host"])

    def grouped(table: pa.Table) -> list[tuple]:
        return [(x["k"], [(y["role"], y["text"]) for y in x["blocks"]]) for x in table.select(["k", "blocks"]).to_pylist()]

    def runs(table: pa.Table) -> pa.Table:
        streams = Streams(grouped(table))
        n = len(streams.start)
        return pa.table({"host": pa.array([table["host"][0].as_py()] * n, pa.string()), "part": pa.array([table["part"][0].as_py()] * n, pa.int64()), "digest": pa.array(streams.digests(), pa.int64()), "pages": pa.array(streams.pages, pa.int64())})

    def group(table: pa.Table, known: pa.Table) -> pa.Table:
        texts = page_texts(grouped(table), dict(zip(known["digest"].to_pylist(), known["elsewhere"].to_pylist()))) if table.num_rows else []
        return pa.table({"k": table["k"], "url": table["url"], "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    read = rows.select("k", "url", "html", "host", "part")
    schema = f"k {id_type}, url string, blocks array<struct<role:tinyint,text:string>>, host string, part bigint"
    parsed = read.mapInArrow(parser(useful), schema)
    # Only hosts of several groups have runs elsewhere, and only undecided pages ask for them; then every block
    # counts that counts within a group, or a page's text would depend on how its host is dealt.
    spread = rows.filter("parts is not null")
    tables = Tables(pages.sparkSession, "runs")
    asking = tables.keep(spread.select("html", "host").mapInArrow(hosts, "host string").distinct(), "asking")
    dealt = spread.join(asking, "host", "left_semi").select("k", "url", "html", "host", "part").mapInArrow(parser(useful), schema)
    found = tables.keep(dealt.groupBy("host", "part").applyInArrow(runs, "host string, part bigint, digest bigint, pages bigint"), "runs")
    both = found.groupBy("host", "digest").agg(F.sum("pages").alias("n"), F.count("*").alias("groups")).filter("groups > 1").drop("groups")
    known = found.join(both, ["host", "digest"]).select("host", "part", "digest", (F.col("n") - F.col("pages")).alias("elsewhere"))
    out = parsed.groupBy("host", "part").cogroup(known.groupBy("host", "part")).applyInArrow(group, f"k {id_type}, url string, text string, n_chars bigint")
    return out.withColumnRenamed("k", id_col)


def op3_html_extract(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
