"""Every registered query against its SQL counterpart, value by value."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.oracle import compare
from timeward.registry import load_all

QUERIES = entry.queries()
SQL = entry.oracle_sql()

# Rows-only queries whose data at this size cannot support the metric.
_NEEDS_MORE_ROWS = {"k09_training_metrics"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SMALL), duck, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - _NEEDS_MORE_ROWS))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry_runs(spark):
    found = entry.entry(spark)
    assert found.count() > 0
    assert "card_txn_count_24h" in found.columns


def test_every_query_says_what_it_covers():
    assert all(e.covers for e in load_all().values())
