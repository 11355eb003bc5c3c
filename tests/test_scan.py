"""Running values and as-of joins of keys that lie in many tasks."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import asof, scan

START = datetime(2024, 1, 1)


@pytest.fixture
def parts(spark):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    yield 12
    spark.conf.set("spark.sql.shuffle.partitions", was)


def rows_of(seed, n, hot=0.4):
    """Rows of a hot key, of a null key and of small ones; times tie often."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if draw.random() < hot else draw.choice([None, *"abcdefgh"])
        out.append((key, START + timedelta(seconds=draw.randrange(n)), i, draw.choice([None, round(draw.random(), 3)])))
    return out


@pytest.mark.parametrize("how", ["last", "sum", "max"])
@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("before", [False, True])
def test_running_values_equal_a_loop(spark, parts, how, backward, before):
    rows = rows_of(1, 900)
    frame = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, x double")
    got = scan.scanned(scan.dealt(frame, ["k"], ["ts", "id"], backward), ["k"], ["ts", "id"], F.col("x"), "y", how, backward, before)
    assert got.columns == ["k", "ts", "id", "x", "_p", "y"]
    expected, held = {}, {}
    for k, _, i, x in sorted(rows, key=lambda r: r[1:3], reverse=backward):
        old = held.get(k)
        new = old if x is None else x if old is None or how == "last" else old + x if how == "sum" else max(old, x)
        held[k] = new
        expected[i] = old if before else new
    found = {r["id"]: r["y"] for r in got.collect()}
    assert found.keys() == expected.keys()
    assert all((a is None and b is None) or abs(a - b) < 1e-9 for a, b in ((found[i], expected[i]) for i in found))


def test_peers_count_together(spark, parts):
    rows = [("k", t // 5, 1) for t in range(600)]
    frame = spark.createDataFrame(rows, "k string, t long, one long")
    got = scan.scanned(scan.dealt(frame, ["k"], ["t"]), ["k"], ["t"], F.col("one"), "y", "sum", peers=True)
    assert {(r["t"], r["y"]) for r in got.collect()} == {(t, 5 * t + 5) for t in range(120)}


@pytest.mark.parametrize("tolerance", [None, 0.0, 5.0, 400.0])
def test_asof_of_a_hot_key_equals_the_plain_window(spark, parts, tolerance):
    frame = spark.createDataFrame(rows_of(2, 1500), "k string, ts timestamp_ntz, id long, x double")
    left, right = frame.where("id % 3 = 0").select("k", "ts", "id"), frame.where("id % 3 > 0").withColumn("lost", F.lit(1))
    for join in (asof.asof_backward, asof.asof_forward):
        plain, split = (sorted(map(tuple, join(left, right, ["k"], ["id", "x"], tolerance, large=n).collect()), key=str) for n in (10**9, 10))
        assert plain == split
        assert len(plain) == 500
        assert any(r[3] is not None for r in plain)


def test_asof_beside_a_key_without_right_rows(spark, parts):
    """The hot key's only quote comes first; it reaches the last range. Another key has none."""
    times = [START + timedelta(seconds=i) for i in range(2000)]
    left = spark.createDataFrame([("hot", t, i) for i, t in enumerate(times)] + [("none", t, -i) for i, t in enumerate(times[:50])], "k string, ts timestamp_ntz, id long")
    right = spark.createDataFrame([("hot", START, 7, 1.5)], "k string, ts timestamp_ntz, id long, x double")
    found = asof.asof_backward(left, right, ["k"], ["x"], large=10).groupBy("k", "q_x").agg(F.count("*").alias("n"))
    assert {tuple(r) for r in found.collect()} == {("hot", 1.5, 2000), ("none", None, 50)}


def test_no_task_has_over_twice_the_median(spark, parts):
    frame = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 1000).cast("string")).alias("k"), "id", F.lit(1).alias("one"))
    found = scan.scanned(scan.dealt(frame, ["k"], ["id"]), ["k"], ["id"], F.col("one"), "y", "sum")
    sizes = [r["n"] for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 60_000
    assert len(sizes) >= 10
    assert max(sizes) <= 2 * median(sizes)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan.split("Window")[1].split("Sort")[1].split("\n")[1]
