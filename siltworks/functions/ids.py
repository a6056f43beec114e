"""Stable ids and hashes; their forms are fixed so that ids stay comparable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltworks.functions.urls import slug


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def stable_id(canonical_url: Column) -> Column:
    return F.concat(F.lit("src_"), F.substring(_sha(canonical_url), 1, 20))


def content_hash(title: Column, text: Column, excerpt: Column) -> Column:
    return _sha(F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(text, F.lit("")), F.coalesce(excerpt, F.lit(""))))


def run_id(at: Column) -> Column:
    return F.concat(F.lit("run_"), F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"))


def candidate_id(title: Column, published: Column) -> Column:
    return F.concat(F.lit("cand_"), F.substring(_sha(F.concat(title, F.coalesce(published, F.lit("")))), 1, 16))


def claim_id(candidate: Column, ordinal: Column) -> Column:
    return F.concat(F.lit("clm_"), slug(F.regexp_replace(candidate, "^cand_", "")), F.lit("_"), F.lpad(ordinal.cast("string"), 2, "0"))


def dedupe_key(entity: Column, event_type: Column, published: Column) -> Column:
    return F.concat_ws("|", slug(entity), event_type, F.substring(published, 1, 10))


def story_id(event: Column) -> Column:
    return F.concat(F.lit("story_"), F.substring(_sha(event), 1, 12))


def trend_id(route: Column) -> Column:
    return F.concat(F.lit("trend_"), F.substring(_sha(route), 1, 12))


def issue_id(day: Column) -> Column:
    return F.concat(F.lit("issue_"), F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("_w"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def fingerprint(value: Column) -> Column:
    return _sha(F.to_json(value))
