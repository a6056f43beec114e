import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(session.conf.get("spark.checkpoint.dir"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def oracle():
    """Runs DuckDB SQL over the tables of a folder; rows as sorted lists of text."""
    import duckdb

    names = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

    def run(sql, sf_dir=SMALL):
        c = duckdb.connect()
        c.execute("set timezone = 'UTC'")
        for t in names:
            c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
        return table(c.execute(sql).df())

    return run


def table(pdf):
    """Column names and rows in an order that does not depend on either engine."""
    pdf = pdf[sorted(pdf.columns)]

    def cell(v):
        if v is None or v != v if not hasattr(v, "__len__") else False:
            return None
        if hasattr(v, "tolist"):
            v = v.tolist()
        return repr(v)

    return list(pdf.columns), sorted(tuple(map(str, map(cell, r))) for r in pdf.itertuples(index=False))
