"""Every registered query against its SQL on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from catalog.registry import spark_queries
from tools.check import compare, oracle

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", list(SQL))
def test_query_agrees_with_sql(spark, con, name):
    good, note = compare(entry.queries()[name](spark, SF), con, SQL[name])
    assert good, note


def test_every_query_has_sql():
    # Those the catalog registers; queries of the subpackage that SQL cannot express are held
    # against plain versions in its own tests.
    assert set(spark_queries()) <= set(SQL) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
