"""Training corpus pipeline: five stages over ``documents``.

1. ``toxicity``: documents that the model scores 0.5 or more go.
2. ``near_duplicates``: one document of each class stays, that of the smallest id.
3. ``decontamination``: documents that the contamination rule names go; from the others
   spans of ``MAX_SPAN`` words or more that stand in the benchmark are cut.
4. ``pii``: texts are pseudonymised.
5. ``mixing``: every document left is a row with the words that the mix takes of it.

Each function takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet in the shared folder and reads again as the next stage's docs.
All but the last return the columns of ``documents``.

Null, empty and word-less texts pass every stage (no rule names them) and have size 0 in
the mix.  Rows that repeat an id and its text are one document from ``near_duplicates``
on; an id with several texts keeps each text that is first of its class.  Rows without
an id stay.  Empty tables give empty results; further columns pass through whatever
their names, but for the last stage, which returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltworks.llm import decontaminate, mixing, neardup, pii, toxicity, workspace

#: Words of the benchmark in a row that are cut from documents that stay: the contract's window.
MAX_SPAN = decontaminate.WINDOW


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows of ``documents`` and applies the model to ``docs``."""
    model = toxicity.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), max_span=MAX_SPAN - 1)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(docs, key=pii.key_of(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", pseudonymise),
    ("mixing", mix_sources),
]

#: SQL cannot express the toxicity model or the keyed permutations; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, after writing and rereading every stage."""
    path = workspace.scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{path}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
