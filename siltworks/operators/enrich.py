"""Model enrichment of the shortlist: input text, cache, provider interface, checks.

A provider is any callable from a list of input texts to a list of JSON texts; the
default is a deterministic stub, since nothing here reaches a network.  Results are
cached by candidate and fingerprint of the exact input.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions.text import excerpt

ANALYSIS = "candidate_id string, intelligence_type string, intelligence_type_reason string, importance_score int, strategy_relevance_score int, confidence string, proposed_claims array<string>, verification_questions array<string>, recommended_disposition string, disposition_reason string, source_ids array<string>"
#: A claim that only repeats a field's name or an empty mark says nothing.
FIELDS = tuple(part.split()[0] for part in ANALYSIS.split(", "))
EMPTY_MARKS = ("", "-", "none", "null", "n/a", "todo", "tbd")
#: The fields of an answer by kind, all required and no others, and the values that some are limited to.
TEXT_FIELDS = "candidate_id canonical_title intelligence_type intelligence_type_reason primary_route track same_event_group what why confidence recommended_disposition disposition_reason".split()
LIST_FIELDS = "secondary_routes proposed_claims missing_evidence verification_questions source_ids".split()
SCORE_FIELDS = "importance_score novelty_score strategy_relevance_score".split()
VALUES = {"track": ["track.fixed", "track.emerging"], "confidence": ["low", "medium", "high"], "recommended_disposition": ["p1", "p2", "watch", "reject"]}
Provider = Callable[[list[str]], list[str]]


@dataclass(frozen=True)
class Settings:
    """Model settings, from the environment with range checks."""

    base_url: str = "http://127.0.0.1:11434"
    timeout_seconds: int = 120
    batch: int = 8
    most_candidates: int = 25

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, prefix: str = "SILTWORKS_MODEL_") -> Settings:
        env = dict(os.environ) if env is None else env
        number = lambda name, default, low, high: _ranged(name, env.get(prefix + name.upper(), default), low, high)
        url = env.get(f"{prefix}BASE_URL", cls.base_url)
        plain = url.startswith("http://") and url.split("//", 1)[1].split("/")[0].split(":")[0] not in ("localhost", "127.0.0.1")
        if plain or not url.startswith(("http://", "https://")):
            raise ValueError("plain HTTP is for this machine only")
        return cls(url, number("timeout_seconds", 120, 1, 3600), number("batch", 8, 1, 100), number("most_candidates", 25, 1, 500))


def _ranged(name: str, value, low: int, high: int) -> int:
    number = int(value)
    if not low <= number <= high:
        raise ValueError(f"{name} must be {low} to {high}")
    return number


def inputs(candidates: DataFrame, members: DataFrame) -> DataFrame:
    """(candidate_id, input, fingerprint): nested JSON without routing context.

    ``members`` has candidate_id, place, source_id, publisher, source_type, raw_title,
    raw_excerpt, raw_text and canonical_url; a candidate's sources are few.
    """
    source = F.struct("place", "source_id", "publisher", "source_type", F.col("raw_title").alias("title"), excerpt(F.col("source_type"), F.col("raw_excerpt"), F.col("raw_text")).alias("excerpt"), F.col("canonical_url").alias("url"))
    listed = members.select("candidate_id", source.alias("s")).groupBy("candidate_id").agg(F.array_sort(F.collect_list("s")).alias("sources"))
    shown = F.filter("matched_signals", lambda s: ~s.startswith("routing_context:"))
    joined = candidates.join(listed, "candidate_id", "left")
    text = F.to_json(F.struct("candidate_id", F.col("canonical_title").alias("title"), "primary_route", "score", shown.alias("signals"), "source_ids", "sources"))
    return joined.select("candidate_id", text.alias("input")).withColumn("fingerprint", F.sha2(F.col("input").cast("binary"), 256))


def stub(texts: list[str]) -> list[str]:
    """A fixed answer from the input's own fields."""
    out = []
    for t in texts:
        x = json.loads(t)
        score = max(0, min(100, 4 * int(x.get("score") or 0)))
        out.append(json.dumps({"candidate_id": x["candidate_id"], "intelligence_type": "technology", "intelligence_type_reason": "rule score", "importance_score": score, "strategy_relevance_score": score, "confidence": "low", "proposed_claims": [x.get("title") or ""], "verification_questions": [], "recommended_disposition": "p1" if score >= 70 else "p2", "disposition_reason": "rule score", "source_ids": x.get("source_ids") or []}))
    return out


def enrich(wanted: DataFrame, cache: DataFrame | None = None, provider: Provider = stub, batch: int = 8) -> DataFrame:
    """(candidate_id, fingerprint, answer, analysis, cached): cached answers of equal inputs, else the provider's.

    A cached row without a fingerprint counts for no input; an answer that is no JSON of
    the schema is an error.
    """
    empty = wanted.sparkSession.createDataFrame([], "candidate_id string, fingerprint string, answer string")
    # A cache that was written twice has one answer of an input: the first in order.
    known = (cache if cache is not None else empty).filter("fingerprint is not null").groupBy("candidate_id", "fingerprint").agg(F.min("answer").alias("answer"))
    # One pass: inputs are made once, and an answered row takes its answer through without its input.
    joined = wanted.join(known, ["candidate_id", "fingerprint"], "left").select("candidate_id", "fingerprint", "answer", F.when(F.col("answer").isNull(), F.col("input")).alias("input"))

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            cached = pdf["answer"].notna()
            texts, answers = pdf.loc[~cached, "input"].tolist(), []
            for a in range(0, len(texts), batch):
                part = texts[a : a + batch]
                said = provider(part)
                if len(said) != len(part):
                    raise ValueError("the provider must answer every input")
                answers += said
            # A frame for each batch would cost more than the answers.
            pdf.loc[~cached, "answer"] = answers
            yield pdf[["candidate_id", "fingerprint", "answer"]].assign(cached=cached)

    both = joined.mapInPandas(ask, "candidate_id string, fingerprint string, answer string, cached boolean")
    return both.withColumn("analysis", F.from_json("answer", ANALYSIS, {"mode": "FAILFAST"}))


def clamp_sources(analyses: DataFrame, candidates: DataFrame) -> DataFrame:
    """Cited sources limited to the candidate's own, in cited order; all of them where none is left."""
    own = candidates.select("candidate_id", F.col("source_ids").alias("_own"))
    kept = F.array_intersect("source_ids", "_own")
    return analyses.join(own, "candidate_id").withColumn("source_ids", F.when(F.size(kept) > 0, kept).otherwise(F.col("_own"))).drop("_own")


def violations(analyses: DataFrame, candidates: DataFrame, types: list[str]) -> DataFrame:
    """(rule, key): coverage, type, reason, score against disposition, confidence and placeholders."""
    from siltworks.operators.joins import coverage
    from siltworks.operators.validate import row_rules

    high = F.greatest(F.coalesce("importance_score", F.lit(0)), F.coalesce("strategy_relevance_score", F.lit(0))) >= 70
    rules = {
        "type": F.col("intelligence_type").isin(*types),
        "type_reason": F.btrim(F.coalesce("intelligence_type_reason", F.lit(""))) != "",
        "high_score_rejected": ~(high & (F.coalesce("recommended_disposition", F.lit("")) == "reject")),
        "overconfident": F.coalesce("confidence", F.lit("")) != "high",
        "placeholder": ~F.exists(F.coalesce("proposed_claims", F.array().cast("array<string>")), lambda c: F.lower(F.btrim(c)).isin(*FIELDS, *EMPTY_MARKS)),
    }
    return row_rules(analyses, "candidate_id", rules).unionByName(coverage(candidates, analyses, "candidate_id").select(F.col("problem").alias("rule"), F.col("candidate_id").alias("key")))


def schema_violations(answers: DataFrame, types: list[str], routes: list[str]) -> DataFrame:
    """(rule, key, field) of the JSON texts (candidate_id, answer) that break the closed schema.

    Rules: not_json (no object), missing, extra, type (text, list of texts, whole number)
    and value (outside the listed values, or a score outside 0 to 100).  JSON null is a type.
    """
    rows = answers.select(F.col("candidate_id").alias("key"), "answer", F.try_parse_json("answer").alias("v"))
    rows = rows.withColumn("ok", F.coalesce(F.schema_of_variant("v").startswith("OBJECT<"), F.lit(False)))
    allowed = VALUES | {"intelligence_type": types, "primary_route": routes, "secondary_routes": routes}

    def checked(name: str):
        value = F.try_variant_get("v", f"$.{name}", "variant")
        kind = F.schema_of_variant(value)
        listed = F.array(*[F.lit(x) for x in allowed.get(name, [])]).cast("array<string>")
        if name in SCORE_FIELDS:
            good, number = kind == "BIGINT", F.try_variant_get("v", f"$.{name}", "bigint")
            inside = number.between(0, 100)
        elif name in LIST_FIELDS:
            good = kind.isin("ARRAY<STRING>", "ARRAY<VOID>") & (F.try_variant_get("v", f"$.{name}[0]", "string").isNotNull() | (kind == "ARRAY<VOID>"))
            inside = F.forall(F.try_variant_get("v", f"$.{name}", "array<string>"), lambda x: F.array_contains(listed, x)) if name in allowed else F.lit(True)
        else:
            good = kind == "STRING"
            inside = F.array_contains(listed, F.try_variant_get("v", f"$.{name}", "string")) if name in allowed else F.lit(True)
        rule = F.when(value.isNull(), "missing").when(~good, "type").when(~F.coalesce(inside, F.lit(False)), "value")
        return F.struct(rule.alias("rule"), F.lit(name).alias("field"))

    every = [*TEXT_FIELDS, *LIST_FIELDS, *SCORE_FIELDS]
    extra = F.transform(F.array_except(F.json_object_keys("answer"), F.array(*[F.lit(x) for x in every])), lambda k: F.struct(F.lit("extra").alias("rule"), k.alias("field")))
    broken = F.filter(F.concat(F.array(*[checked(x) for x in every]), extra), lambda x: x["rule"].isNotNull())
    none = F.array(F.struct(F.lit("not_json").alias("rule"), F.lit("").alias("field")))
    return rows.select("key", F.explode(F.when(F.col("ok"), broken).otherwise(none)).alias("x")).select("x.rule", "key", "x.field")
