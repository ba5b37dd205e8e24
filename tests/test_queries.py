"""Every registered query against its SQL, over the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks import oracle, spark_queries
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"
QUERIES, SQL = spark_queries.all_queries(), oracle.all_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    problem, n = differences(spark, con, QUERIES[name], SQL[name], SF)
    assert not problem
    assert n > 0


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 90
