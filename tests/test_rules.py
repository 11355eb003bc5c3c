"""Live rules: verdicts that don't depend on batches, bars that never come, sessions taken over."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_feeds import in_batches, run
from tidegauge.streaming import rules

DAY = datetime(2024, 1, 3)
SCHEMA = "k string, name string, bar_start timestamp, arrived timestamp, value double"


def bar(name, hour, value, late=0, k="m", day=DAY):
    start = day + timedelta(hours=hour)
    return (k, name, start, start + timedelta(hours=1, seconds=late), value)


LEADERS = rules.LeaderRule({"a": 0.5, "b": 0.8}, "c", 2 * 3600)


def verdicts(spark, path, batches, rule, session=(0, 86_400), initial=None):
    stream = in_batches(spark, path, batches, SCHEMA)
    live = rules.live_sessions(stream, rule, F.col("k"), F.col("name"), 3600, 90, session, initial=initial)
    return sorted((r["key"], (r["bar_start"] - DAY).total_seconds() / 3600, r["verdict"]) for r in run(live, path).collect())


def plain_leaders(rows, rule, session, end):
    """All bars up to ``end`` (hours), by a loop."""
    held = {}
    for _, name, start, arrived, value in rows:
        if arrived <= start + timedelta(hours=1, seconds=90):
            held.setdefault((start - DAY).total_seconds() / 3600, {})[name] = value
    out, hot, present, until = [], False, False, -1e9
    for h in range(end):
        v = held.get(h, {})
        inside = session[0] <= h * 3600 <= session[1]
        now = inside and any(v.get(k) is not None and v[k] >= x for k, x in rule.leaders.items()) and (v.get("c") or 0) > 0
        if inside and ("c" not in v or not v.keys() & {"a", "b"}):
            out.append(("m", float(h), "missed"))
        elif now and present and not hot:
            out.append(("m", float(h), "blocked" if h * 3600 < until else "signal"))
            until = h * 3600 + rule.hold if h * 3600 >= until else until
        hot, present = now, bool(v)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_verdicts_do_not_depend_on_batches(spark, tmp_path, seed):
    draw = random.Random(seed)
    rows = [bar(n, h, draw.choice([0.9, 0.9, 0.1, -0.2, None]), draw.choice([0, 0, 0, 30, 300])) for h in range(18) for n in "abc" if draw.random() < 0.9]
    rows.sort(key=lambda r: r[3])
    rows.append(bar("a", 23, 0.0, k="other"))  # time goes on
    session = (3 * 3600, 16 * 3600)
    expected = plain_leaders(rows[:-1], LEADERS, session, 18)
    assert {v for _, _, v in expected} >= {"signal", "missed"}
    for i, size in enumerate((len(rows), 5)):
        got = verdicts(spark, f"{tmp_path}/{i}", [rows[j : j + size] for j in range(0, len(rows), size)], LEADERS, session)
        assert [x for x in got if x[0] == "m"] == expected


def test_a_bar_that_never_comes_is_missed(spark, tmp_path):
    """The confirmer's bar of hour 2 doesn't come, nor does any bar after hour 3; other markets tell the time."""
    rule = rules.LeaderRule({"a": 0.5}, "c", 0)
    batches = [[bar("a", 0, 0.1), bar("c", 0, 1.0)], [bar("a", 1, 0.9), bar("c", 1, 1.0)], [bar("a", 2, 0.9)], [bar("a", 3, 0.1), bar("c", 3, 1.0)], [bar("a", 6, 0.1, k="other")], [bar("a", 7, 0.1, k="other")]]
    got = verdicts(spark, tmp_path, batches, rule, (0, 5 * 3600))
    assert [x for x in got if x[0] == "m"] == [("m", 1.0, "signal"), ("m", 2.0, "missed"), ("m", 4.0, "missed"), ("m", 5.0, "missed")]


def test_tails_of_a_session(spark, tmp_path):
    """Only the first entry of a day signals, late bars are missed and don't count, and the next day begins anew."""
    rule, tomorrow = rules.TailRule(-0.5), DAY + timedelta(days=1)
    rows = [bar("bar", 0, -0.6, late=200), bar("bar", 1, 0.0), bar("bar", 2, -0.7), bar("bar", 3, -0.9), bar("bar", 4, None), bar("bar", 5, -0.6), bar("bar", 0, -0.8, day=tomorrow), bar("bar", 12, 0.0, day=tomorrow)]
    session = (0, 5 * 3600)
    for i, size in enumerate((1, 8)):
        got = verdicts(spark, f"{tmp_path}/{i}", [rows[j : j + size] for j in range(0, 8, size)], rule, session)
        assert got == [("m", 0.0, "missed"), ("m", 2.0, "signal"), ("m", 24.0, "signal"), *(("m", 24.0 + h, "missed") for h in range(1, 6))]


def test_a_session_goes_on_from_its_initial_state(spark, tmp_path):
    """Another run was at hour 5, with a hot bar before it and a hold until hour 7."""
    micros = int((DAY - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    hour = 3_600_000_000
    initial = spark.createDataFrame([("m", micros, micros + 5 * hour, True, True, micros + 7 * hour, False)], "key string, day long, upcoming long, present boolean, hot boolean, until long, entered boolean")
    rule = rules.LeaderRule({"a": 0.5}, "c", 2 * 3600)
    values = {5: 0.9, 6: 0.1, 7: 0.9, 8: 0.1, 9: 0.9}
    rows = [bar(n, h, v if n == "a" else 1.0) for h, v in values.items() for n in "ac"]
    got = verdicts(spark, tmp_path, [rows], rule, (0, 9 * 3600), initial)
    assert got == [("m", 7.0, "signal"), ("m", 9.0, "signal")]
