"""Tables between steps, in the shared checkpoint folder."""

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from siltworks.operators.checkpoints import with_checkpoints

__all__ = ["Tables", "bounded_batches", "scratch", "with_checkpoints"]

BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
#: Within ``Tables.keep`` shuffle files go as soon as a query has ended, and Python gets small batches.
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", BATCH_SETTING: str(BATCH_BYTES)}


def bounded_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of about ``BATCH_BYTES``, where the session names no size of its own."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{with_checkpoints(spark).sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def with_settings(spark: SparkSession):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class Tables:
    """Compressed Parquet tables of one job: they cut lineage, outlive executors and can be dropped early."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = scratch(spark, name)
        self.names: set[str] = set()

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        with with_settings(self.spark):
            frame.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        self.names.add(name)
        return self.spark.read.schema(frame.schema).parquet(f"{self.path}/{name}")

    def drop_others(self, *names: str) -> None:
        self.drop(*self.names.difference(names))

    def drop(self, *names: str) -> None:
        for name in self.names.intersection(names):
            self.names.discard(name)
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
