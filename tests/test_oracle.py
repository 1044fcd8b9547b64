"""Every query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry_point
from tests.conftest import TESTDATA
from verification.compare import difference, duckdb_on
from verification.oracle import ORACLE_SQL
from verification.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    return duckdb_on(TESTDATA)


def test_every_query_has_its_sql():
    found = entry_point.queries()
    assert list(found)[: len(QUERIES)] == list(QUERIES)
    assert set(QUERIES) <= set(entry_point.oracle_sql()) <= set(found)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, connection, name):
    assert difference(entry_point.queries()[name](spark, TESTDATA), ORACLE_SQL[name], connection) is None


def test_raw_and_typed_fixtures_are_the_same_rows(spark):
    from verification import fixtures as fx

    for typed, typing in ((fx.faturas, "typed_faturas"), (fx.pagamentos, "typed_pagamentos")):
        left, right = typed(spark, TESTDATA), QUERIES[typing](spark, TESTDATA)
        assert left.dtypes == right.dtypes
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
