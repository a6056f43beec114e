"""The checkpoint folder that iterative operators cut their lineage with."""

from pyspark.sql import SparkSession


def with_checkpoints(spark: SparkSession) -> SparkSession:
    """Sets a checkpoint folder where the session names none (local tests only)."""
    if not spark.sparkContext.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # On one machine the warehouse is as shared as any folder.
        spark.sparkContext.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return spark
