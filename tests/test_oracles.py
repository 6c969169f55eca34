"""Every registered query against its SQL on a second engine."""

import pytest

import __spark_entry__ as spark_entry
from registry.compare import compare, duck_connection

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = spark_entry.queries(), spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duck_connection(SF_DIR)
    yield connection
    connection.close()


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), ORACLES[name], duck) == []


def test_entry_runs(spark):
    assert spark_entry.entry(spark).count() > 0
