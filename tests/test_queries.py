"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests import oracle
from tidegauge.plans import registry

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connection()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    oracle.same(spark, registry.queries()[name], SQL[name], con)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    df = registry.queries()[name](spark, oracle.SF)
    assert df.columns
    df.collect()


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
