"""URL functions as Column expressions: no parser that raises, no re-encoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that only track, besides any that begins with utm_.
TRACKING = ("fbclid", "gclid", "ref", "source", "spm")
#: Hosts and path whose fragment names a story of its own.
STORY_HOSTS = ("deeplearning.ai", "www.deeplearning.ai")
STORY_PATH = "/the-batch/issue-"
#: Hosts of one preprint archive, whose paths may end in a version.
ARCHIVE_HOSTS = ("arxiv.org", "www.arxiv.org")

#: RFC 3986, appendix B: scheme, authority, path, query, fragment.
PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(url: Column, n: int) -> Column:
    return F.regexp_extract(F.trim(url), PARTS, n)


def host(url: Column) -> Column:
    return F.lower(part(url, 2))


def canonicalize_url(url: Column, tracking: tuple[str, ...] = TRACKING) -> Column:
    """Scheme and host in lower case, tracking parameters, trailing slashes and fragment gone.

    Kept parameters stay as they are written.  A null stays null.
    """
    where = host(url)
    archive = where.isin(*ARCHIVE_HOSTS)
    path = F.regexp_replace(part(url, 3), "/+$", "")
    path = F.when(archive, F.regexp_replace(path, r"v\d+$", "")).otherwise(path)
    path = F.when(path == "", "/").otherwise(path)
    name = lambda p: F.lower(F.substring_index(p, "=", 1))
    kept = F.filter(F.split(part(url, 4), "&"), lambda p: (p != "") & ~name(p).isin(*tracking) & ~name(p).startswith("utm_"))
    query = F.array_join(kept, "&")
    scheme = F.when(archive, "https").otherwise(F.lower(part(url, 1)))
    place = F.when(archive, ARCHIVE_HOSTS[0]).otherwise(where)
    fragment = F.when(where.isin(*STORY_HOSTS) & path.startswith(STORY_PATH), part(url, 5)).otherwise("")
    mark = lambda sign, text: F.when(text == "", "").otherwise(F.concat(F.lit(sign), text))
    return F.concat(F.when(scheme == "", "").otherwise(F.concat(scheme, F.lit(":"))), mark("//", place), path, mark("?", query), mark("#", fragment))


def valid_url(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^(?i:https?)://[^/?#]+"), F.lit(False))


def slug(text: Column, most: int = 36) -> Column:
    """Lower case, runs of anything but a-z and 0-9 as one underscore, none at the ends, cut."""
    return F.substring(F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_")), 1, most)


def source_label(url: Column, labels: list[tuple[str, str]], other: str = "Source") -> Column:
    """The label of the first listed part that the host contains."""
    chosen = F.lit(other)
    for piece, label in reversed(labels):
        chosen = F.when(host(url).contains(piece), label).otherwise(chosen)
    return chosen


def rewrite_url(url: Column, rules: list[tuple[str, str]]) -> Column:
    """Literal replacements, in order."""
    for old, new in rules:
        url = F.replace(url, F.lit(old), F.lit(new))
    return url
