"""Every registered query against its SQL on the smallest data set."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from mortar.plans import registry
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_sql_has_a_query_and_every_query_a_sql():
    registry.load()
    assert set(registry.SQL) == set(registry.QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


registry.load()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(queries()[name](spark, SF), con, oracle_sql()[name]) == ""
