"""Windowed aggregates of live streams; each function takes a stream or, as its batch twin, a table.

Lateness is bounded by the watermark. Rows later than it go to ``late_rows`` and are merged afterwards by the additive
upsert, so that nothing is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WATERMARK = "10 minutes"


def second_bars(trades: DataFrame, by: list[str], width: str = "1 second", watermark: str = WATERMARK) -> DataFrame:
    """Per window and key: trades, volumes of either side in base and quote, last price. Columns ts, price, size, side."""
    side = lambda s, x: F.sum(F.when(F.col("side") == s, x).otherwise(0.0))
    quote = F.col("price") * F.col("size")
    out = trades.withWatermark("ts", watermark).groupBy(*by, F.window("ts", width).alias("w")).agg(
        F.count("*").alias("trades"),
        side("buy", F.col("size")).alias("buy_volume"),
        side("sell", F.col("size")).alias("sell_volume"),
        side("buy", quote).alias("buy_quote"),
        side("sell", quote).alias("sell_quote"),
        F.max_by("price", F.struct("ts", "id")).alias("last_price"),
    )
    return out.select(*by, F.col("w.start").alias("bucket"), *[c for c in out.columns if c not in (*by, "w")])


def latest_fields(updates: DataFrame, by: list[str], fields: list[str], width: str = "1 second", watermark: str = WATERMARK) -> DataFrame:
    """Per window and key the latest value of each field that isn't null."""
    last = [F.max_by(f, F.when(F.col(f).isNotNull(), F.struct("ts", "id"))).alias(f) for f in fields]
    out = updates.withWatermark("ts", watermark).groupBy(*by, F.window("ts", width).alias("w")).agg(*last)
    return out.select(*by, F.col("w.start").alias("bucket"), *fields)


def liquidations(events: DataFrame, by: list[str], width: str = "1 second", watermark: str = WATERMARK) -> DataFrame:
    """Per window and key the notional of either side, each event id once."""
    once = events.withWatermark("ts", watermark)
    once = once.dropDuplicatesWithinWatermark(["id"]) if events.isStreaming else once.dropDuplicates(["id"])
    notional = F.col("price") * F.col("size")
    side = lambda s: F.sum(F.when(F.col("side") == s, notional).otherwise(0.0))
    out = once.groupBy(*by, F.window("ts", width).alias("w")).agg(side("buy").alias("buy_notional"), side("sell").alias("sell_notional"))
    return out.select(*by, F.col("w.start").alias("bucket"), "buy_notional", "sell_notional")


def observations(ticks: DataFrame, by: list[str], width: str = "60 seconds", watermark: str = WATERMARK) -> DataFrame:
    """Per window and key the last observation: its time, price and size."""
    last = F.max_by(F.struct("ts", "price", "size"), F.struct("ts", "id")).alias("o")
    out = ticks.withWatermark("ts", watermark).groupBy(*by, F.window("ts", width).alias("w")).agg(last)
    return out.select(*by, F.col("w.start").alias("bucket"), F.col("o.ts").alias("observed_at"), "o.price", "o.size")


def pretrigger(detections: DataFrame, ticks: DataFrame, by: list[str], minutes: int = 120, watermark: str = WATERMARK) -> DataFrame:
    """Observations of the ``minutes`` up to each detection of their key: an interval join, whose state the watermarks
    bound. detections: keys, detected_at, detection."""
    d, o = detections.withWatermark("detected_at", watermark).alias("d"), ticks.withWatermark("ts", watermark).alias("o")
    condition = F.col("o.ts").between(F.col("d.detected_at") - F.expr(f"INTERVAL {minutes} MINUTES"), F.col("d.detected_at"))
    for k in by:
        condition = (F.col(f"d.{k}") == F.col(f"o.{k}")) & condition
    return d.join(o, condition).select(*(F.col(f"d.{k}").alias(k) for k in by), "detection", "detected_at", "o.ts", "o.price")


def late_rows(df: DataFrame, arrived: Column, allowed: str) -> tuple[DataFrame, DataFrame]:
    """Rows in time and rows whose event time is further than ``allowed`` behind their arrival."""
    on_time = F.col("ts") >= arrived - F.expr(f"INTERVAL {allowed}")
    return df.where(on_time), df.where(~on_time)


def idempotent(write: Callable[[DataFrame, int], None], done: Callable[[int], bool], mark: Callable[[int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes each batch id once, so that a replay after a failure counts nothing twice."""

    def batch(df: DataFrame, batch_id: int) -> None:
        if not done(batch_id):
            write(df, batch_id)
            mark(batch_id)

    return batch


def once_per_batch(path: str, parts: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """An idempotent foreachBatch function: the batch's aggregated parts go to a folder of its id, which the file sink
    leaves without _SUCCESS until all is written. A replayed batch finds it and writes nothing; one that failed half-way
    is written again."""
    folder = lambda i: f"{path}/batch={i}"

    def fs_path(df: DataFrame, i: int):
        spark = df.sparkSession
        marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder(i)}/_SUCCESS")
        return marker.getFileSystem(spark._jsc.hadoopConfiguration()), marker

    def batch(df: DataFrame, i: int) -> None:
        fs, marker = fs_path(df, i)
        step = idempotent(lambda d, k: parts(d).write.mode("overwrite").parquet(folder(k)), lambda k: fs.exists(marker), lambda k: None)
        step(df, i)

    return batch


def segments(stream: DataFrame, path: str, checkpoint: str, by: list[str], width: str = "15 minutes"):
    """Raw rows as gzip JSON lines below a folder for each key and segment of time."""
    placed = stream.withColumn("segment", F.date_format(F.window("ts", width)["start"], "yyyyMMdd'T'HHmm"))
    return placed.writeStream.format("json").option("compression", "gzip").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*by, "segment")
