"""Places of rows that move once."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.operators import screen
from tidegauge.operators.quantiles import sorted_places


def test_places_are_row_numbers(spark):
    df = spark.range(3000).select((F.col("id") % 7 % 3).alias("g"), F.xxhash64("id").alias("x"), "id")
    got = {(r["g"], r["id"], r["n"]) for r in sorted_places(df, ["g"], ["x"], ["g", "id"], "n").collect()}
    assert got == {(r["g"], r["id"], r["n"]) for r in df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("x"))).collect()}


def test_what_orders_dealt_rows_is_not_moved_again(spark):
    df = spark.range(50).select((F.col("id") % 2).alias("g"), "id", F.col("id").cast("double").alias("v"))
    plan = screen.permuted(df, ["g"], ["id"], ["s", "t"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "_key" not in plan
