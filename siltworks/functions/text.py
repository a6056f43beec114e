"""Text functions as Column expressions, and one pandas UDF where Spark has none."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Words that say nothing in a title.
STOP_WORDS = ("a", "an", "the", "for", "from", "of", "to", "with", "via", "and", "in", "on", "towards")
CJK = "[\\u4e00-\\u9fff]"
WHITE = r"(?U)\s+"


def clean_html(value: Column) -> Column:
    """Scripts, styles and tags as spaces, white space folded; empty becomes null."""
    text = F.regexp_replace(value, r"(?is)<script\b[^>]*>.*?</script>", " ")
    text = F.regexp_replace(text, r"(?is)<style\b[^>]*>.*?</style>", " ")
    text = F.regexp_replace(text, "<[^>]+>", " ")
    return F.nullif(F.btrim(F.regexp_replace(text, WHITE, " ")), F.lit(""))


def language_hint(text: Column, configured: Column | str | None = "und") -> Column:
    given = configured if isinstance(configured, Column) else F.lit(configured)
    return F.when(text.rlike(CJK), "zh-CN").otherwise(F.coalesce(F.nullif(given, F.lit("")), F.lit("und")))


def normalize_title(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.replace(F.lower(text), F.lit("$"), F.lit("")), "[^a-z0-9\\u4e00-\\u9fff]+", " "))


def tokens(text: Column) -> Column:
    """Distinct title words of two or more characters, without stop words."""
    return F.array_distinct(F.filter(F.split(normalize_title(text), " "), lambda w: (F.length(w) > 1) & ~w.isin(*STOP_WORDS)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values; 0 where both are empty."""
    both = F.size(F.array_intersect(a, b))
    all_ = F.size(F.array_union(a, b))
    return F.when(all_ > 0, both / all_).otherwise(0.0)


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio; for the few pairs that a cheaper bound lets through."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])


def similarity(a: Column, b: Column) -> Column:
    return F.greatest(jaccard(tokens(a), tokens(b)), sequence_ratio(normalize_title(a), normalize_title(b)))


def matches(text: Column, terms: list[str], mode: str = "substring") -> Column:
    """The terms that the text contains, in the order given; ``mode='word'`` wants whole words."""
    low = F.lower(F.coalesce(text, F.lit("")))
    listed = F.array(*[F.lit(t) for t in terms]) if terms else F.array().cast("array<string>")
    if mode == "word":
        padded = F.concat(F.lit(" "), F.regexp_replace(low, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
        return F.filter(listed, lambda t: F.contains(padded, F.concat(F.lit(" "), F.lower(t), F.lit(" "))))
    return F.filter(listed, lambda t: F.contains(low, F.lower(t)))


def matches_any(text: Column, terms: list[str]) -> Column:
    return F.size(matches(text, terms)) > 0


def excerpt(source_type: Column, text: Column, raw: Column, filing: int = 6000, other: int = 1800) -> Column:
    """The excerpt, or else the text, cut by kind of source."""
    whole = F.coalesce(F.nullif(text, F.lit("")), raw, F.lit(""))
    return F.substr(whole, F.lit(1), F.when(source_type == "financial_report", filing).otherwise(other))
