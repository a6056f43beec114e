"""Time functions: everything becomes a UTC timestamp; text is made only at a sink."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Date notations of investor relations pages, tried in order.
DATE_FORMATS = ("yyyy.M.d", "yyyy/M/d", "yyyy-M-d", "MMMM d, yyyy", "MMM d, yyyy")
RFC_2822 = ("EEE, d MMM yyyy HH:mm:ss Z", "EEE, d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z")


def iso(ts: Column) -> Column:
    """``2026-08-05T00:00:00Z``, with microseconds where there are any."""
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)), F.lit("Z"))


def parse_publication_date(value: Column) -> Column:
    """First of five notations that fits; week days and a short September are let go."""
    text = F.regexp_replace(F.btrim(F.regexp_replace(value, r"(?U)\s+", " ")), "^Sept ", "Sep ")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS])


def parse_iso_datetime(value: Column) -> Column:
    text = F.btrim(value)
    # EEE is accepted by the parser only without the zone's brackets, so the day's name goes first.
    bare = F.regexp_replace(text, r"^[A-Za-z]{3}, ", "")
    mail = [F.try_to_timestamp(bare, F.lit(f)) for f in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z")]
    return F.coalesce(text.try_cast("timestamp"), *mail)


def unix_datetime(value: Column) -> Column:
    """Seconds, or milliseconds above 1e10; anything else is null."""
    number = value.try_cast("double")
    return F.timestamp_micros((number * F.when(number > 1e10, 1e3).otherwise(1e6)).try_cast("bigint"))


def feed_time(published: Column, updated: Column, created: Column) -> Column:
    return F.coalesce(*[parse_iso_datetime(c) for c in (published, updated, created)])
