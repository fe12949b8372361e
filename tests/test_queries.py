"""Every registered query that has SQL against it, at the smallest scale."""

import pytest
from compare import connect, difference

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0
