"""Silences as they happen, late rows, and merges of batches into slices."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import T0
from tidegauge.operators.features import gaps
from tidegauge.operators.writes import merge_additive, upsert
from tidegauge.streaming import feeds, stateful


def in_batches(spark, path, batches, schema):
    """A stream that reads one batch after the other: files are read in the order of their times."""
    import os

    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/tmp{i}")
        part = next(f for f in os.listdir(f"{path}/tmp{i}") if f.endswith(".parquet"))
        os.makedirs(f"{path}/in", exist_ok=True)
        os.rename(f"{path}/tmp{i}/{part}", f"{path}/in/{i:03}.parquet")
        os.utime(f"{path}/in/{i:03}.parquet", (1_700_000_000 + 60 * i,) * 2)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def run(stream, path):
    stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def found_gaps(spark, path, batches, over, watermark):
    stream = feeds.feed_gaps(in_batches(spark, path, batches, "k string, ts timestamp"), "k", over, watermark=watermark)
    return {tuple(r) for r in run(stream, path).collect()}


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def test_a_feed_that_falls_silent_for_ever(spark, tmp_path):
    batches = [[("dead", at(0)), ("live", at(0))]] + [[("live", at(30 * i))] for i in range(1, 10)]
    got = found_gaps(spark, tmp_path, batches, 60.0, "10 seconds")
    assert got == {("dead", at(0), None)}


def test_a_silence_is_told_when_it_opens_and_when_it_ends(spark, tmp_path):
    batches = [[("a", at(0)), ("b", at(0))], [("b", at(50)), ("b", at(100))], [("b", at(150)), (None, at(151))], [("a", at(160)), ("b", at(200))], [("b", at(250)), ("a", at(215))], [("b", at(290)), ("a", at(260))], [("b", at(320)), ("a", at(300))]]
    got = found_gaps(spark, tmp_path, batches, 60.0, "10 seconds")
    assert got == {("a", at(0), None), ("a", at(0), at(160))}


def test_closed_gaps_equal_the_batch_twin_whatever_the_order_within_the_delay(spark, tmp_path):
    draw = random.Random(4)
    times = {k: sorted(at(s) for s in draw.sample(range(4000), 60)) for k in "abc"}
    rows = sorted(((k, t) for k in times for t in times[k]), key=lambda r: r[1] + timedelta(seconds=draw.randrange(100)))
    rows.append(("z", at(9000)))
    batches = [rows[i : i + 12] for i in range(0, len(rows), 12)]
    got = found_gaps(spark, tmp_path, batches, 90.0, "500 seconds")
    frame = spark.createDataFrame(rows, "k string, ts timestamp")
    expected = {(r["k"], r["gap_start"], r["gap_end"]) for r in gaps(frame, ["k"], over=90.0).collect()}
    assert {g for g in got if g[2] is not None} == expected
    assert {g[0] for g in got if g[2] is None and g[1] == times[g[0]][-1]} == set("abc")


SCHEMA = "day string, k string, n long"


def added(old, new):
    return merge_additive([old, new], ["day", "k"], ["n"], [], "n")


def held(merge, spark):
    return {(r["day"], r["k"]): r["n"] for r in merge.rows(spark).collect()}


def files(path, day):
    import os

    return set(os.listdir(f"{path}/_slice={day}"))


def test_a_batch_writes_the_slices_that_it_touches(spark, tmp_path):
    path = f"{tmp_path}/t"
    merge = feeds.SliceMerge(path, SCHEMA, F.col("day"), added)
    first = spark.createDataFrame([(f"d{i}", k, 1) for i in range(6) for k in "ab"], SCHEMA)
    assert sorted(merge(first, 0)) == [f"d{i}" for i in range(6)]
    before = {i: files(path, f"d{i}") for i in range(6)}
    assert merge(spark.createDataFrame([("d2", "a", 5), ("d2", "c", 7)], SCHEMA), 1) == ["d2"]
    assert {i for i in range(6) if files(path, f"d{i}") != before[i]} == {2}
    assert held(merge, spark)["d2", "a"] == 6
    assert held(merge, spark)["d2", "c"] == 7
    assert len(held(merge, spark)) == 13


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    merge = feeds.SliceMerge(f"{tmp_path}/t", SCHEMA, F.col("day"), added)
    batches = [spark.createDataFrame([("d1", "a", i + 1), (f"d{i}", "b", 1), (None, "c", 1)], SCHEMA) for i in range(3)]
    for i, b in enumerate(batches):
        merge(b, i)
    after = held(merge, spark)
    assert after["d1", "a"] == 6
    assert after[None, "c"] == 3
    assert merge(batches[2], 2) == []
    assert held(merge, spark) == after


def test_a_batch_that_failed_half_way_is_finished(spark, tmp_path):
    """Slice d1 was written, d2 not: the replay leaves the one and merges the other."""
    merge = feeds.SliceMerge(f"{tmp_path}/t", SCHEMA, F.col("day"), added)
    merge(spark.createDataFrame([("d1", "a", 1), ("d2", "a", 1)], SCHEMA), 0)
    merge(spark.createDataFrame([("d1", "a", 10)], SCHEMA), 1)
    assert merge(spark.createDataFrame([("d1", "a", 10), ("d2", "a", 20)], SCHEMA), 1) == ["d2"]
    assert held(merge, spark) == {("d1", "a"): 11, ("d2", "a"): 21}


def test_upserts_merge_by_slice(spark, tmp_path):
    merge = feeds.SliceMerge(f"{tmp_path}/t", SCHEMA, F.col("day"), lambda old, new: upsert(old, new, ["day", "k"], "n"))
    merge(spark.createDataFrame([("d1", "a", 3), ("d1", "b", 3)], SCHEMA), 0)
    merge(spark.createDataFrame([("d1", "a", 2), ("d1", "b", 4)], SCHEMA), 1)
    assert held(merge, spark) == {("d1", "a"): 3, ("d1", "b"): 4}


@pytest.mark.parametrize("delay", [10.0, 10_000.0])
def test_rows_hours_late_end_in_the_sums(spark, tmp_path, delay):
    schema = "k string, ts timestamp, n long"
    batches = [[("a", at(0), 1), ("b", at(7200), 2)], [("a", at(60), 4), ("b", at(7300), 8)], [("a", at(-86_400), 16), ("a", at(7290), 32)]]
    stream = in_batches(spark, tmp_path, batches, schema)
    hourly = lambda rows: rows.groupBy("k", F.date_trunc("hour", "ts").alias("hour")).agg(F.sum("n").alias("n"))
    into = feeds.SliceMerge(f"{tmp_path}/t", "k string, hour timestamp, n long", F.col("hour").cast("date"), lambda old, new: merge_additive([old, new], ["k", "hour"], ["n"], [], "n"))
    write = feeds.LateRows(f"{tmp_path}/side", delay, hourly, into)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    whole = spark.createDataFrame([r for b in batches for r in b], schema)
    assert {tuple(r) for r in into.rows(spark).select("k", "hour", "n").collect()} == {tuple(r) for r in hourly(whole).collect()}
    late = {(r["n"], r["batch"]) for r in write.late(spark, schema).collect()}
    assert late == ({(4, 1), (16, 2)} if delay == 10.0 else {(16, 2)})
    assert write.watermark(spark, 0) is None
    assert write.watermark(spark, 2) == int((at(7300) - datetime(1970, 1, 1)).total_seconds() * 1e6 - delay * 1e6)


def test_every_decision_about_targets_is_logged(spark, tmp_path):
    log = feeds.TargetLog(f"{tmp_path}/t", 2, stateful.admitted)
    schema = "asset string, expires double, score double, seen double"
    batches = [[("a", 110.0, 5.0, 100.0), ("b", 111.0, 9.0, 101.0)], [("c", 112.0, 7.0, 102.0), ("a", 113.0, 6.0, 103.0)], [("b", 150.0, 1.0, 140.0)]]
    for i, rows in enumerate(batches):
        log(spark.createDataFrame(rows, schema), i)
    got = sorted((r["batch"], r["asset"], r["rank"], r["reason"]) for r in log.log(spark).collect())
    assert got == [(0, "a", 2, "admitted"), (0, "b", 1, "admitted"), (1, "a", 3, "cap reached"), (1, "c", 2, "admitted"), (2, "b", 1, "admitted")]
    log(spark.createDataFrame(batches[1], schema), 1)  # a replay
    assert sorted((r["batch"], r["asset"], r["rank"], r["reason"]) for r in log.log(spark).where("batch <> 1").collect()) == [x for x in got if x[0] != 1]
    assert log.log(spark).count() == 5
