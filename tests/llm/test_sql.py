"""Queries whose whole result SQL can express, against it."""

import pytest

from tests.compare import connect, differences
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_query_agrees_with_sql(spark, name):
    problem, n = differences(spark, connect(SF), queries.all_queries()[name], queries.all_sql()[name], SF)
    assert not problem
    assert n > 0
