"""Streams over copies of more files than a batch takes, which stand in no order of time."""

from __future__ import annotations

import pytest

from tests import oracle
from tidegauge.plans import registry


@pytest.fixture
def many_files(spark):
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "12"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["T13_live_rule", "T13_live_leaders", "T13_live_tails"])
def test_rules_see_bars_in_order(spark, many_files, name):
    oracle.same(spark, registry.queries()[name], registry.oracle_sql()[name], oracle.connection())
