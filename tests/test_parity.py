"""Every registered query equals its SQL counterpart."""

import pytest
from compare import connect, difference, duck_rows, spark_rows
from conftest import SMALL

import __spark_entry__ as spec

QUERIES = spec.library_queries()
ORACLE = spec.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert difference(spark_rows(QUERIES[name](spark, SMALL)), duck_rows(duck, ORACLE[name])) is None


def test_entry_has_rows(spark):
    assert spec.entry(spark).count() > 0
