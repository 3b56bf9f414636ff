import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.queries import QUERIES
from checks.compare import difference, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["metro_area", "word", "count"] and df.count() > 0
