"""Streams against their batch twins, and the stateful rules."""

from __future__ import annotations

import json
import time
from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.streaming import aggregates, stateful

T0 = datetime(2024, 1, 2, 10, 0)


def run(spark, stream, path, mode="append"):
    q = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/cp").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out").collect()


@contextmanager
def without_empty_batches(spark):
    """States that expire by the machine's clock call for a batch without end."""
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    yield
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def source(spark, df, path, files=4):
    df.repartition(files).write.parquet(f"{path}/in")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def ticks(spark, n=200):
    rows = [(i, "x" if i % 2 else "y", T0 + timedelta(seconds=i), 100.0 + i % 7, 1.0, "buy" if i % 3 else "sell") for i in range(n)]
    return spark.createDataFrame(rows, "id int, k string, ts timestamp, price double, size double, side string")


def test_trade_windows_stream_equals_batch(spark, tmp_path):
    # a last row an hour later closes all windows before it
    df = ticks(spark).union(spark.createDataFrame([(999, "x", T0 + timedelta(hours=1), 1.0, 1.0, "buy")], ticks(spark).schema))
    stream = aggregates.second_bars(source(spark, df, tmp_path, 1), ["k"], "10 seconds", "10 minutes")
    got = {tuple(r) for r in run(spark, stream, tmp_path)}
    batch = {tuple(r) for r in aggregates.second_bars(df, ["k"], "10 seconds").where(F.col("bucket") < T0 + timedelta(minutes=30)).collect()}
    assert got == batch


def test_liquidations_count_once(spark, tmp_path):
    df = ticks(spark, 50)
    end = spark.createDataFrame([(999, "x", T0 + timedelta(hours=1), 1.0, 1.0, "buy")], df.schema)
    stream = aggregates.liquidations(source(spark, df.union(df).union(end), tmp_path, 1), ["k"], "1 minute")
    got = {tuple(r) for r in run(spark, stream, tmp_path)}
    assert got == {tuple(r) for r in aggregates.liquidations(df, ["k"], "1 minute").collect()}


def test_pretrigger_stream(spark, tmp_path):
    df = ticks(spark, 40)
    d = spark.createDataFrame([("x", T0 + timedelta(seconds=20), 1)], "k string, detected_at timestamp, detection int")
    d.write.parquet(f"{tmp_path}/d")
    detections = spark.readStream.schema(d.schema).parquet(f"{tmp_path}/d")
    got = run(spark, aggregates.pretrigger(detections, source(spark, df, tmp_path), ["k"], 120), tmp_path)
    assert len(got) == 10


def test_idempotent_batches():
    wrote, done = [], set()
    f = aggregates.idempotent(lambda df, i: wrote.append(i), done.__contains__, done.add)
    for i in (0, 1, 1, 0, 2):
        f(None, i)
    assert wrote == [0, 1, 2]


def test_segments_sink(spark, tmp_path):
    q = aggregates.segments(source(spark, ticks(spark, 20), tmp_path), f"{tmp_path}/seg", f"{tmp_path}/cp2", ["k"]).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.json(f"{tmp_path}/seg").count() == 20


def test_book_rules():
    b = stateful.Book(depth=2)
    b.apply([(99.0, 5.0), (98.0, 3.0)], [(101.0, 2.0), (102.0, 4.0)], True)
    m = b.metrics()
    assert (m["bid_depth"], m["ask_depth"]) == (8, 6) and m["imbalance"] > 0 and 99 < m["microprice"] < 101
    b.apply([(99.0, 0.0)], [], False)
    assert b.metrics()["bid"] == 98.0
    b.apply([(105.0, 1.0)], [], False)
    assert b.metrics() is None  # crossed
    b.apply([(101.0, 1.0)], [(101.0, 1.0)], True)
    assert b.metrics()["spread_bps"] == 0  # locked
    b.apply([(float(i), 1.0) for i in range(1, 50)], [], False)
    assert len(b.bids) <= 6


def test_book_stream_equals_fold(spark, tmp_path):
    rows, book, expected = [], stateful.Book(), []
    for i in range(12):
        kind = "snapshot" if i == 0 else "update"
        bids, asks = [[99 - i % 3, i % 4]], [[101 + i % 2, 1 + i % 3]]
        rows.append(("b", T0 + timedelta(seconds=i), kind, json.dumps(bids), json.dumps(asks)))
        book.apply([tuple(x) for x in bids], [tuple(x) for x in asks], kind == "snapshot")
        if (m := book.metrics()) is not None:
            expected.append((T0 + timedelta(seconds=i), m["bid"], m["ask"]))
    df = spark.createDataFrame(rows, "book string, ts timestamp, kind string, bids string, asks string")
    got = run(spark, stateful.book_states(source(spark, df, tmp_path, 1)), tmp_path)
    assert sorted((r["ts"], r["bid"], r["ask"]) for r in got) == expected


def observe(d, t, provider, price, market="spot", volume=None):
    return d.observe(t, provider, market, "S", price, volume)


def fired(d, *steps):
    """The last step's triggers."""
    out = None
    for step in steps:
        out = observe(d, *step)
    return out and out["triggers"].split(",")


def test_detector_fast_and_cooldown():
    d = stateful.Detector()
    assert observe(d, 0, "a", 100.0) is None
    hit = observe(d, 60, "a", 101.0)
    assert hit is not None and hit["triggers"].startswith("fast")
    assert observe(d, 120, "a", 103.0) is None  # cooling down
    assert observe(d, 100, "a", 110.0) is None  # older than the last one of the venue
    assert observe(d, 359, "a", 103.5) is None
    assert observe(d, 421, "a", 106.0) is not None


def test_each_trigger_of_the_detector():
    D = stateful.Detector
    assert fired(D(), (0, "a", 100.0), (60, "a", 100.75)) == ["fast"]
    assert fired(D(), (0, "a", 100.0), (60, "a", 100.74)) is None
    assert fired(D(), (0, "a", 100.0), (76, "a", 109.0)) is None  # the last observation before is too old for the window
    assert fired(D(), (0, "a", 100.0), (300, "a", 101.51)) == ["base"]
    assert fired(D(), (0, "a", 100.0), (900, "a", 102.51)) == ["slow"]
    assert fired(D(), (0, "a", 100.0), (0, "b", 100.0), (300, "a", 100.8), (320, "b", 100.8)) == ["cross_venue"]
    assert fired(D(), (0, "a", 100.0), (0, "a", 100.0, "perp"), (300, "a", 100.8), (320, "a", 100.8, "perp")) is None  # one provider
    assert fired(D(), (0, "a", 100.0), (0, "b", 100.0), (300, "a", 100.8), (346, "b", 100.8)) is None  # evidence has gone stale
    assert fired(D(), (0, "a", 100.0), (1, "b", 100.0, "perp"), (300, "a", 100.4), (301, "b", 101.2, "perp")) == ["derivative_led"]
    assert fired(D(), (0, "b", 100.0, "perp"), (300, "b", 101.2, "perp")) is None  # no spot
    volume = [(0, "a", 100.0, "spot", 0.0), (300, "a", 100.0, "spot", 10.0)]
    assert fired(D(), *volume, (600, "a", 100.6, "spot", 40.0)) == ["volume"]
    assert fired(D(), *volume, (600, "a", 100.6, "spot", 39.0)) is None
    assert fired(D(), *volume, (600, "a", 100.4, "spot", 99.0)) is None


def test_volume_trigger_needs_one_venue_to_have_both():
    d = stateful.Detector()
    for t, quiet, busy in ((0, 100.0, 0.0), (300, 100.0, 10.0)):
        observe(d, t, "a", quiet, "spot", 1.0)
        observe(d, t, "b", 100.0, "spot", busy)
    assert observe(d, 600, "a", 100.6, "spot", 1.0) is None
    assert observe(d, 600, "b", 100.0, "spot", 99.0) is None  # the rise is a's, the surge b's


def test_detector_drops_bad_prices_and_unknown_volumes():
    d = stateful.Detector()
    observe(d, 0, "a", 100.0, "spot", float("nan"))
    assert observe(d, 10, "a", 0.0) is None and observe(d, 11, "a", -5.0) is None and observe(d, 12, "a", None) is None
    assert observe(d, 13, "a", float("nan")) is None
    observe(d, 20, "c", 50.0)  # a venue without any move is no provider
    hit = observe(d, 60, "a", 101.0, "spot", float("nan"))
    assert hit["providers"] == 1 and hit["score"] == pytest.approx(30 * (1 / 0.75) + 8 + 8 * (1 / 0.75))


def test_detector_stream_equals_the_cooldown_over_the_batch_twin(spark):
    """The stream folds one observation after the other, the twin is windows over the table."""
    from tests import oracle
    from tidegauge.operators import events
    from tidegauge.plans import inputs, stream_queries

    table = inputs.read(spark, oracle.SF, "events")
    batch = stateful.batch_detections(stream_queries.observed(table), stream_queries.SPARSE)
    timed = batch.withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    expected = sorted((r["asset"], round(r["t"], 3), r["triggers"], r["providers"], round(r["score"], 6)) for r in events.cooldown(timed, ["asset"], stream_queries.SPARSE.cooldown).collect())
    got = sorted((r["asset"], round(r["ts"], 3), r["triggers"], r["providers"], round(r["score"], 6)) for r in stream_queries.multi_venue_detections(spark, oracle.SF).collect())
    assert len(got) > 20 and got == expected
    assert {t for r in got for t in r[2].split(",")} >= set(stateful.TRIGGERS) - {"derivative_led"}


def test_detector_state_is_kept_between_batches(spark, tmp_path):
    steps = [(0.0, 100.0), (60.0, 101.0), (120.0, 103.0), (421.0, 106.0), (900.0, 100.0)]
    df = spark.createDataFrame([("x", t, "a", "spot", "S", p, None) for t, p in steps], "asset string, t double, provider string, market string, symbol string, price double, volume double")
    df.coalesce(1).sortWithinPartitions("t").limit(2).write.parquet(f"{tmp_path}/in/1")
    df.where("t > 60").coalesce(1).write.parquet(f"{tmp_path}/in/2")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("latestFirst", False).parquet(f"{tmp_path}/in")
    d, expected = stateful.Detector(), []
    for t, p in steps:
        if observe(d, t, "a", p) is not None:
            expected.append(t)
    with without_empty_batches(spark):
        assert sorted(r["ts"] for r in run(spark, stateful.multi_venue(stream), tmp_path)) == expected == [60.0, 421.0]


def test_dead_venues_leave_the_state(spark, tmp_path):
    """1000 venues that speak once, and one that goes on: after their time only the live one is held."""
    schema = "asset string, t double, provider string, market string, symbol string, price double, volume double"
    dead = spark.createDataFrame([("x", float(i % 50), f"p{i}", "spot", "S", 100.0 + i, None) for i in range(1000)], schema)
    dead.coalesce(1).write.parquet(f"{tmp_path}/in/1")
    sizes = []
    with without_empty_batches(spark):
        for t in (60.0, 2000.0, 2060.0):
            stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
            q = stateful.multi_venue(stream, ttl=1500).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
            q.awaitTermination()
            sizes.append(sum(s["numRowsTotal"] for s in q.lastProgress["stateOperators"]))
            time.sleep(2)
            spark.createDataFrame([("x", t, "live", "spot", "S", 100.0, None)], schema).coalesce(1).write.parquet(f"{tmp_path}/in/t{t}")
    assert sizes[0] >= 1000
    assert sizes[-1] < 20


def test_targets_expire_and_rank(spark, tmp_path):
    rows = [("a", 0.0, 5.0), ("b", 1.0, 9.0), ("c", 2.0, 5.0), ("a", 3.0, 4.0), ("d", -20.0, 99.0)]
    df = spark.createDataFrame(rows, "asset string, ts double, score double").withColumn("at", F.timestamp_seconds(F.col("ts") + 1_704_189_600))
    changes = run(spark, stateful.targets(source(spark, df, tmp_path, 1), 10.0), tmp_path)
    got = {r["asset"]: r for r in stateful.admitted(spark.createDataFrame(changes, stateful.TARGET_SCHEMA), 4.0, 2).collect()}
    assert set(got) == {"a", "b", "c"}  # d has expired
    assert [(k, got[k]["rank"], got[k]["admitted"]) for k in "bca"] == [("b", 1, True), ("c", 2, True), ("a", 3, False)]
    assert (got["a"]["expires"], got["a"]["score"], got["a"]["seen"]) == (13.0, 4.0, 3.0)
    assert {r["asset"] for r in stateful.admitted(spark.createDataFrame(changes, stateful.TARGET_SCHEMA), 11.5, 2).collect()} == {"c", "a"}


def test_expired_targets_leave_the_state(spark, tmp_path):
    schema = "asset string, ts double, score double"
    first, later = [("a", 0.0, 5.0)], [("b", 100_000.0, 1.0)]
    for i, rows in enumerate((first, later, [("a", 100_001.0, 2.0)])):
        spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_seconds(F.col("ts") + 1_704_189_600)).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in/0").schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    got = run(spark, stateful.targets(stream, 10.0), tmp_path)
    assert sorted((r["asset"], r["expires"], r["score"]) for r in got) == [("a", 10.0, 5.0), ("a", 100_011.0, 2.0), ("b", 100_010.0, 1.0)]


def test_live_rules_stream_equals_the_fold(spark, tmp_path):
    import random

    draw, rows, expected = random.Random(4), [], []
    for entity in "xyz":
        state, start = None, 0.0
        for _ in range(60):
            start += draw.choice([60.0, 60.0, 120.0])
            bar = (entity, start, start + 60, start + 60 + draw.choice([1.0, 100.0]), draw.choice([-1.0, -0.6, 0.2]))
            rows.append(bar)
            state, verdict = stateful.live_rule(state, {"start": bar[1], "end": bar[2], "ret": bar[4]}, -0.5, 300.0, 90.0, bar[3])
            if verdict != "none":
                expected.append((entity, bar[1], verdict))
    df = spark.createDataFrame(rows, "entity string, bar_start double, bar_end double, arrived double, ret double").orderBy(F.rand(1))
    got = run(spark, stateful.live_rules(source(spark, df, tmp_path, 1), -0.5, 300.0, 90.0), tmp_path)
    assert sorted((r["entity"], r["bar_start"], r["verdict"]) for r in got) == sorted(expected)
    assert {r["verdict"] for r in got} == {"signal", "missed", "blocked"}


def test_replayed_batches_are_written_once(spark, tmp_path):
    put = aggregates.once_per_batch(f"file://{tmp_path}/rows", lambda d: d.groupBy("k").agg(F.count("*").alias("n")))
    df = ticks(spark, 20)
    for i in (0, 0, 1, 0):
        put(df, i)
    assert spark.read.parquet(f"file://{tmp_path}/rows").agg(F.sum("n")).first()[0] == 40
    import os

    os.remove(f"{tmp_path}/rows/batch=1/_SUCCESS")  # as if the batch had failed half-way
    put(df, 1)
    assert spark.read.parquet(f"file://{tmp_path}/rows").agg(F.sum("n")).first()[0] == 40


def test_live_rule():
    bar = lambda i, r: {"start": 60.0 * i, "end": 60.0 * (i + 1), "ret": r}
    state, v = stateful.live_rule(None, bar(0, -1.0), -0.5, 300, 90, 61)
    assert v == "signal"
    state, v = stateful.live_rule(state, bar(1, -1.0), -0.5, 300, 90, 121)
    assert v == "none"  # still below
    state, v = stateful.live_rule(state, bar(2, 0.0), -0.5, 300, 90, 181)
    state, v = stateful.live_rule(state, bar(3, -1.0), -0.5, 300, 90, 241)
    assert v == "blocked"
    _, v = stateful.live_rule(None, bar(9, -1.0), -0.5, 300, 90, 9999)
    assert v == "missed"
