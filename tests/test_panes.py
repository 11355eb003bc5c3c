"""Moving aggregates by panes against frames, and greedy selection by ranges against the fold."""

from __future__ import annotations

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.functions.time import shift
from tidegauge.operators import events, panes

START = datetime(2024, 1, 1)


def series(spark, n, seed=1, scale=1e6):
    draw = random.Random(seed)
    rows = [(draw.choice("ab"), START + timedelta(seconds=draw.randrange(4 * n)), i, draw.choice([None, scale + draw.random()])) for i in range(n)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, x double")


def near(a, b):
    return a is None and b is None or abs(a - b) <= 1e-9 * max(1.0, abs(b))


@pytest.mark.parametrize("n", [1, 2, 7, 64, 5000])
def test_frames_of_rows(spark, n):
    frame = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(1 - n, 0)
    out = panes.over_rows(series(spark, 900), ["k"], ["ts", "id"], "x", n, "s")
    assert out.columns == ["k", "ts", "id", "x", "s"]
    both = out.withColumns({"c": F.count("x").over(frame), "m": F.avg("x").over(frame), "d": F.var_samp("x").over(frame), "lo": F.min("x").over(frame), "hi": F.max("x").over(frame)})
    rows = both.withColumns({"pm": panes.average("s"), "pd": panes.deviation("s")}).collect()
    assert len(rows) == 900
    for r in rows:
        assert (r["s"]["n"], r["s"]["least"], r["s"]["greatest"]) == (r["c"], r["lo"], r["hi"])
        assert near(r["pm"], r["m"])
        assert (r["pd"] is None) == (r["c"] < 2)
        assert r["pd"] is None or near(r["pd"] ** 2, r["d"])


@pytest.mark.parametrize(("a", "b"), [(60, 0), (300, 15), (90_000, 900), (10, 9)])
def test_frames_of_time(spark, a, b):
    df = series(spark, 900, 2).unionByName(spark.createDataFrame([("a", None, 9999, 1.0)], "k string, ts timestamp_ntz, id long, x double"))
    t = F.timestamp_diff("SECOND", F.lit(START).cast("timestamp_ntz"), F.col("ts"))
    frame = Window.partitionBy("k").orderBy(t).rangeBetween(-a, -b)
    out = panes.over_time(df, ["k"], "ts", "x", a, b, "s")
    rows = out.withColumns({"m": F.when(F.col("ts").isNotNull(), F.avg("x").over(frame)), "hi": F.when(F.col("ts").isNotNull(), F.max("x").over(frame)), "pm": panes.average("s")}).collect()
    assert len(rows) == 901
    assert all(near(r["pm"], r["m"]) and (r["s"]["greatest"] if r["s"] else None) == r["hi"] for r in rows)


def test_time_does_not_grow_with_the_frame(spark):
    df = spark.range(60_000).select(F.lit("k").alias("k"), "id", F.rand(1).alias("x")).repartition(1).cache()
    df.count()

    def seconds(n):
        began = time.perf_counter()
        panes.over_rows(df, ["k"], ["id"], "x", n, "s").agg(F.sum("s.mean")).collect()
        return time.perf_counter() - began

    seconds(50)
    short, long = min(seconds(50), seconds(50)), min(seconds(20_000), seconds(20_000))
    df.unpersist()
    assert long < 2.5 * short


@pytest.mark.parametrize("lengths", [(5, 40), (1, 2), (0, 3000), (-5, 5)])
def test_greedy_by_ranges_equals_the_fold(spark, lengths):
    draw = random.Random(sum(lengths))
    rows = [("hot" if draw.random() < 0.6 else draw.choice([None, "a", "b"]), START + timedelta(seconds=draw.randrange(3000)), i, draw.randint(*lengths)) for i in range(2000)]
    rows += [("a", None, 5000, 1)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, n int").withColumn("_p", F.lit("mine"))
    end = F.timestamp_add("SECOND", F.col("n"), F.col("ts"))
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        whole, split = (sorted(map(tuple, events.greedy(df, ["k"], "ts", end, "id", large).select("k", "ts", "id", "n").collect()), key=str) for large in (10**9, 10))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert whole == split
    assert 0 < len(whole) <= 2000


def test_one_long_key_is_folded_in_every_task(spark):
    df = spark.range(40_000).select(F.lit(1).alias("k"), shift(F.lit(START).cast("timestamp_ntz"), F.col("id").cast("int")).alias("ts"), "id")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        kept = events.greedy(df, ["k"], "ts", shift("ts", 7), "id", 10)
        assert kept.rdd.getNumPartitions() == 8
        ids = sorted(r["id"] for r in kept.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert ids == list(range(0, 40_000, 7))
