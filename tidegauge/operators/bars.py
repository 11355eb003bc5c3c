"""Bars and minute facts from ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalars import change, ratio
from tidegauge.functions.time import floor_to, seconds_between, shift


def build_bars(
    ticks: DataFrame, by: list[str], width: int, ts: str = "ts", price: str = "price", size: str = "size", tie: str = "id",
    interior: int | None = None, min_rows: int = 1,
) -> DataFrame:
    """Bars of ``width`` seconds: open, high, low, close, volume, quote_volume, n, first and last time, signal_ts (the
    bar's end), vwap, close_vs_vwap, high_to_close. ``interior`` seconds before the end the price in force gives
    ``final_return``. Buckets of fewer than ``min_rows`` rows are left out. Order within a bucket is by (ts, tie). One
    shuffle, with partial aggregation before it."""
    order = F.struct(ts, tie)
    bucket = floor_to(ts, width)
    aggs = [
        F.count("*").alias("n"),
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum(size).alias("volume"),
        F.sum(F.col(price) * F.col(size)).alias("quote_volume"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    ]
    if interior is not None:
        early = seconds_between(bucket, ts) < width - interior
        aggs.append(F.max_by(F.when(early, F.col(price)), F.when(early, order)).alias("_inner"))
    bars = ticks.groupBy(*by, bucket.alias("bucket")).agg(*aggs).where(F.col("n") >= min_rows)
    vwap = ratio("quote_volume", "volume")
    bars = bars.withColumns({"signal_ts": shift("bucket", width), "vwap": vwap}).withColumns(
        {"close_vs_vwap": change("close", "vwap"), "high_to_close": ratio(F.col("high") - F.col("close"), "high")}
    )
    return bars.withColumn("final_return", change("close", "_inner")).drop("_inner") if interior is not None else bars


def incomplete_buckets(bars: DataFrame, by: list[str], expected: int) -> DataFrame:
    """Buckets with fewer rows than expected, and how many are missing."""
    return bars.where(F.col("n") < expected).select(*by, "bucket", "n", F.greatest(F.lit(expected) - F.col("n"), F.lit(0)).alias("missing"))


def minute_facts(trades: DataFrame, by: list[str], width: int = 60) -> DataFrame:
    """Facts of each bucket from trades with side, price, size, id: counts and volumes by side, vwap, first, last, range."""
    side = lambda s: F.col("side") == s
    order = F.struct("ts", "id")
    sums = lambda s: F.coalesce(F.sum(F.when(side(s), F.col("size"))), F.lit(0.0))
    return trades.groupBy(*by, floor_to("ts", width).alias("minute")).agg(
        F.count("*").alias("trades"),
        F.count_if(side("buy")).alias("buys"),
        F.count_if(side("sell")).alias("sells"),
        F.count_if(F.col("side").isNull()).alias("unknown"),
        sums("buy").alias("buy_volume"),
        sums("sell").alias("sell_volume"),
        ratio(F.sum(F.col("price") * F.col("size")), F.sum("size")).alias("vwap"),
        F.min_by("price", order).alias("first_price"),
        F.max_by("price", order).alias("last_price"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
    )


def quote_facts(quotes: DataFrame, by: list[str], spread: Column, width: int = 60) -> DataFrame:
    """Facts of each bucket from valid quotes: count, spread average, range and last quote."""
    order = F.struct("ts", "id")
    return quotes.withColumn("_s", spread).groupBy(*by, floor_to("ts", width).alias("minute")).agg(
        F.count("*").alias("quotes"),
        F.avg("_s").alias("avg_spread_bps"),
        F.min("_s").alias("min_spread_bps"),
        F.max("_s").alias("max_spread_bps"),
        F.max_by("bid", order).alias("last_bid"),
        F.max_by("ask", order).alias("last_ask"),
    )


def merge_facts(trades: DataFrame, quotes: DataFrame, by: list[str], counts: tuple[str, ...] = ("trades", "quotes")) -> DataFrame:
    """Full outer merge of two fact tables of one grain; counts of a missing side are 0."""
    joined = trades.join(quotes, by, "full")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts if c in joined.columns})
