"""Queries with SQL against that SQL on the smallest data set."""

import pytest

from mortar.llm.queries import QUERIES, SQL
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, SQL[name]) == ""
