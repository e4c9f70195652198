"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, difference

QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, sf, name):
    assert difference(spark, duck, sf, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
