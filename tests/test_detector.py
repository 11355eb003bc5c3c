"""The detector's windows: their cost doesn't grow with what they hold, and they find what a plain search finds."""

from __future__ import annotations

import random
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests import oracle
from tidegauge.operators import events
from tidegauge.plans import stream_queries
from tidegauge.plans.inputs import read
from tidegauge.streaming import stateful
from tidegauge.streaming.stateful import OBSERVATION, SIGNAL, Detector, DetectorConfig, Venue

CONFIG = DetectorConfig(fast=60, base=300, slow=900, evidence=45)


def test_windows_find_what_a_search_finds():
    r, venue, kept, t = random.Random(5), Venue("a", "spot"), [], 0.0
    for i in range(3000):
        t += r.choice((0.0, 1.0, 7.0, 20.0, 500.0 if i % 97 == 0 else 3.0))
        kept.append((t, r.uniform(1, 9), r.choice((None, r.uniform(0, 99)))))
        venue.add(*kept[-1], CONFIG)
        kept = [x for x in kept if x[0] >= t - CONFIG.retention]
        assert venue.held == kept
        for s in (*CONFIG.windows, 2 * CONFIG.base):
            assert venue._before(s) == next((x for x in reversed(kept) if x[0] <= t - s), None)


def test_cost_of_an_observation_is_bounded():
    read = [0]

    @dataclass
    class Time(float):
        """A time that counts how often it is compared."""

        def __new__(cls, x):
            return float.__new__(cls, x)

        def __init__(self, x):
            pass

        def _counted(self, f, other):
            read[0] += 1
            return f(self, other)

        __lt__ = lambda self, other: self._counted(float.__lt__, other)
        __le__ = lambda self, other: self._counted(float.__le__, other)
        __gt__ = lambda self, other: self._counted(float.__gt__, other)
        __ge__ = lambda self, other: self._counted(float.__ge__, other)

    venue = Venue("a", "spot")
    for i in range(4000):  # all within the retention
        venue.add(Time(i / 10), 1.0, 1.0, CONFIG)
    assert read[0] < 4000 * 100


def test_no_signal_meets_another(spark):
    """The batch detector has no join, so its work is in proportion to its rows."""
    out = stateful.batch_detections(stream_queries.observed(read(spark, oracle.SF, "events")), stream_queries.SPARSE)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def none(x):
    return None if x != x else x


def test_signals_at_once_are_those_of_one_by_one():
    r, t, rows = random.Random(7), 0.0, []
    for i in range(4000):
        t += r.choice((0.0, 1.0, 7.0, 20.0, 2000.0 if i % 97 == 0 else 3.0))
        rows.append((t - (50.0 if i % 500 == 250 else 0.0), i, r.uniform(1, 9), r.choice((np.nan, r.uniform(0, 99)))))
    venue, expected, found, held = Venue("a", "spot"), [], [], np.empty(0, OBSERVATION)
    for begin, end in ((0, 1), (1, 700), (700, 700), (700, 2250), (2250, 4000)):  # the last batch begins with a row that comes late
        batch = sorted(rows[begin:end], key=lambda x: x[:2])
        for at, i, price, volume in batch:
            if venue.add(at, price, none(volume), CONFIG):
                expected.append((at, i, *venue.signal[1:]))
        signals, held = stateful.venue_signals(held, np.array(batch, OBSERVATION), CONFIG)
        found += [(at, i, *map(none, moves)) for at, i, *moves in signals.tolist()]
        assert [(at, price, none(volume)) for at, _, price, volume in held.tolist()] == venue.held
    assert found == expected and len(found) > 3000


@pytest.mark.parametrize("move, cooldown", [(0.1, 300), (0.3, 300), (0.6, 300), (3.0, 0), (3.0, 40)])
def test_detections_at_once_are_those_of_one_by_one(move, cooldown):
    """Quiet, busy and wild assets, in one batch and in several."""
    r, config, rows, t = random.Random(int(100 * move)), replace(CONFIG, cooldown=cooldown), [], 1000.0
    venues = [("a", "spot"), ("a", "perp"), ("b", "spot"), ("c", "perp")]
    for i in range(3000):
        t += r.choice((0.0, 0.25, 1.0, 30.0 if i % 50 == 0 else 2.0))
        moves = [r.choice((np.nan, 0.0, r.gauss(0, move))) for _ in range(2)] + [r.gauss(0, 2 * move)]
        rows.append((r.randrange(4), (t, i, *moves, r.choice((np.nan, r.uniform(0, 4))))))
    one, several = (Detector(config, {"/".join(v): Venue(*v) for v in venues}) for _ in range(2))
    expected = []
    for v, (at, _, *signal) in rows:
        one.venues["/".join(venues[v])].signal = (at, *map(none, signal))
        expected += [d] if (d := one.fired(at)) else []
    found = []
    for begin, end in ((0, 3), (3, 3), (3, 1700), (1700, 3000)):
        found += stateful.detected(several, np.array([v for v, _ in rows[begin:end]], np.int64), np.array([x for _, x in rows[begin:end]], SIGNAL))
    assert found == expected and several == one
    assert found or move < 0.2


def test_rows_of_a_venue_are_packed():
    """A stateful operator is handed few rows, whatever the number of observations."""
    n, names = 50_000, ["asset", "provider", "market", "symbol"]
    keys = [pa.array([None if i % 5 == 4 else str(i % k) for i in range(n)]) for k in (2, 5, 1, 1)]
    numbers = [pa.array(np.arange(n) / 7), pa.array(np.arange(n)), pa.array(np.ones(n)), pa.array([None if i % 3 else 1.0 for i in range(n)])]
    table = pa.table([*keys, *numbers], names=[*names, *OBSERVATION.names])
    out = [x for batch in stateful.packed(iter(table.to_batches(max_chunksize=10_000))) for x in batch.to_pylist()]
    assert len(out) <= 9 + n // stateful.RECORDS
    back = sorted((i, x["asset"], x["provider"], t, none(volume)) for x in out for t, i, _, volume in np.frombuffer(x["records"], OBSERVATION).tolist())
    assert back == [(i, keys[0][i].as_py(), keys[1][i].as_py(), i / 7, None if i % 3 else 1.0) for i in range(n)]


@pytest.mark.parametrize("rows", [stream_queries.REPLAYED, 300])
def test_files_in_no_order_of_time(spark, tmp_path, monkeypatch, rows):
    """Nothing is taken for late because of the file that it is in, and equal times go by id."""
    found = read(spark, oracle.SF, "events").withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    found.repartition(12, "event_id").write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(stream_queries, "REPLAYED", rows)
    plain = lambda t, r: (r["asset"], t, r["triggers"], r["providers"], round(r["score"], 6))
    got = sorted(plain(r["ts"], r) for r in stream_queries.multi_venue_detections(spark, str(tmp_path)).collect())
    batch = stateful.batch_detections(stream_queries.observed(found), stream_queries.SPARSE)
    chosen = events.cooldown(batch.withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz")), ["asset"], stream_queries.SPARSE.cooldown)
    assert got == sorted(plain(r["t"], r) for r in chosen.collect()) and len(got) > 20
