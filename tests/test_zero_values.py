"""Queries against their SQL on events of which some have the value zero."""

from __future__ import annotations

import os

import pytest

from tests import oracle
from tidegauge.plans import registry


@pytest.fixture(scope="module")
def zeros(tmp_path_factory):
    """The smallest tables, where all values of an hour of each day and those of every fourth event are zero."""
    folder = str(tmp_path_factory.mktemp("zeros"))
    for t in oracle.TABLES:
        os.symlink(f"{oracle.SF}/{t}.parquet", f"{folder}/{t}.parquet") if t != "events" else None
    zero = "case when hour(ts) = 9 or event_id % 4 = 0 then 0.0 else value end as value"
    oracle.connection().execute(f"copy (select * replace ({zero}) from events) to '{folder}/events.parquet' (format parquet)")
    return folder


@pytest.mark.parametrize("name", ["A19_high_low_range", "W2_rolling_ratios"])
def test_zero_values_match_sql(spark, zeros, name):
    oracle.same(spark, registry.queries()[name], registry.oracle_sql()[name], oracle.connection(zeros), zeros)


def test_book_around_zero_and_unknown_level(spark, tmp_path):
    """A book locked at zero has no spread in basis points; an event without value changes no level."""
    rows = "(0, timestamp '2024-01-01 09:00:00', 1, 'view', 0.2, '{}'), (1, timestamp '2024-01-01 09:00:01', 1, 'click', 0.3, '{}'), (2, timestamp '2024-01-01 09:00:02', 1, 'click', null, '{}'), (3, timestamp '2024-01-01 09:00:03', 1, 'click', 4.0, '{}')"
    con = oracle.duckdb.connect()
    con.execute(f"copy (select event_id::bigint as event_id, ts, user_id::bigint as user_id, event_type, value::double as value, props from (values {rows}) t(event_id, ts, user_id, event_type, value, props)) to '{tmp_path}/events.parquet' (format parquet)")
    got = registry.queries()["T2_book_states"](spark, str(tmp_path)).orderBy("ts").collect()
    assert [(r["bid"], r["ask"], r["ask_depth"], r["spread_bps"]) for r in got] == [(0.0, 0.0, 1.0, None), (0.0, 0.0, 1.0, None), (0.0, 0.0, 2.0, None)]
