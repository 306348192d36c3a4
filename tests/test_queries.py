import os

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_point.queries()
SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(spark, con, QUERIES[name], SQL[name], SF_DIR) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry_point.entry(spark), entry_point.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 1
