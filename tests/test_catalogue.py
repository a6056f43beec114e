import pytest
from conftest import SMALL, table

from siltworks.plans import catalogue, run_queries  # noqa: F401


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_against_sql(spark, oracle, name):
    df = catalogue.QUERIES[name](spark, SMALL)
    if name in catalogue.ORACLE_SQL:
        assert table(df.toPandas()) == oracle(catalogue.ORACLE_SQL[name])
    else:
        assert df.count() > 0


def test_entry_lists_every_query():
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
