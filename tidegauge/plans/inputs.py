"""The driver's tables as the series that the operators expect, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.bars import build_bars


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as ticks: entity, venue, ts, id, price, size."""
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("entity"),
        F.col("event_type").alias("venue"),
        "ts",
        F.col("event_id").alias("id"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("size"),
    )


TICKS = "ticks as (select user_id as entity, event_type as venue, ts, event_id as id, value as price, cast(props->>'k' as double) as size from events)"


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of each venue."""
    return build_bars(ticks(spark, sf_dir), ["venue"], 3600)


def bars_sql(name: str, by: str, width: str) -> str:
    return f"""{name} as (
  select {by}, time_bucket(interval '{width}', ts, timestamp '1970-01-01') as bucket, count(*) as n, arg_min(price, ts) as open,
    max(price) as high, min(price) as low, arg_max(price, ts) as close, sum(size) as volume, sum(price * size) as quote_volume,
    min(ts) as first_ts, max(ts) as last_ts,
    time_bucket(interval '{width}', ts, timestamp '1970-01-01') + interval '{width}' as signal_ts,
    sum(price * size) / nullif(sum(size), 0) as vwap
  from ticks group by {by}, time_bucket(interval '{width}', ts, timestamp '1970-01-01'))"""


HOURLY = TICKS + ",\n" + bars_sql("bars", "venue", "1 hour")


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})
