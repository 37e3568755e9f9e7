"""Every query with SQL gives the SQL's rows."""

import os

import pytest

import __spark_entry__ as contract
from tests import oracle

DIRECTORY = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    with oracle.connect(DIRECTORY) as connection:
        yield connection


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    actual = contract.queries()[name](spark, DIRECTORY).toPandas()
    expected = duck.execute(contract.oracle_sql()[name]).df()
    assert oracle.differences(actual, expected) == []
    assert len(actual) > 0


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["country", "host", "requests", "percent"]
    assert df.count() > 0


def test_sql_belongs_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
