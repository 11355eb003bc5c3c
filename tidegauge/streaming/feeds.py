"""Facts about live feeds: silences as they happen, and rows that come too late for the watermark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegauge.operators.scratch import materialize
from tidegauge.operators.writes import upsert

GAP_SCHEMA = "entity string, gap_start long, gap_end long"
_GAP_COLUMNS = ["entity", "gap_start", "gap_end"]


class GapProcessor(StatefulProcessor):
    """Rows: entity, t (microseconds). A silence of over ``limit`` seconds is told twice: as open, without an end, once the
    watermark has passed its limit and nothing has come, and as closed when the next row is final.

    Rows wait in the state until the watermark has passed them, so the order within the watermark's delay doesn't matter
    and closed silences are those of the whole table. A key has one timer: at its first waiting row or where its silence
    becomes open, whichever is earlier.
    """

    def __init__(self, limit: float):
        self.limit = round(limit * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "t long, told boolean")
        self.waiting = handle.getListState("waiting", "t long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        times = [t for part in rows for t in part["t"].tolist()]
        yield self._settled(key, times, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._settled(key, [], timerValues.getCurrentWatermarkInMs())

    def _settled(self, key, times: list[int], watermark: int) -> pd.DataFrame:
        waiting = sorted({*times, *(x[0] for x in self.waiting.get())})
        final = [t for t in waiting if t // 1000 < watermark]
        waiting = waiting[len(final) :]
        last, told = self.last.get() if self.last.exists() else (None, False)
        out = []
        for t in final:
            if last is not None and t - last > self.limit:
                out.append((key[0], last, t))
            if last is None or t > last:
                last, told = t, False
        opens = None if last is None or told else (last + self.limit) // 1000 + 1
        if opens is not None and opens < watermark and (not waiting or waiting[0] > last + self.limit):
            out.append((key[0], last, None))
            opens, told = None, True
        if last is not None:
            self.last.update((last, told))
        if waiting:
            self.waiting.put([(t,) for t in waiting])
        else:
            self.waiting.clear()
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old[0] if isinstance(old, tuple) else old)
        due = min([x for x in (opens, waiting[0] // 1000 + 1 if waiting else None) if x is not None], default=None)
        if due is not None:
            self.handle.registerTimer(max(due, watermark + 1))
        return pd.DataFrame(out, columns=_GAP_COLUMNS).astype({"gap_start": "Int64", "gap_end": "Int64"})

    def close(self) -> None:
        pass


def feed_gaps(rows: DataFrame, by: str, over: float, ts: str = "ts", watermark: str = "10 minutes") -> DataFrame:
    """Silences of each key of over ``over`` seconds: entity (as text), gap_start, gap_end (null while it is open)."""
    timed = rows.where(F.col(by).isNotNull() & F.col(ts).isNotNull()).select(F.col(by).cast("string").alias("entity"), F.col(ts).cast("timestamp").alias("at"))
    timed = timed.withColumn("t", F.unix_micros("at")).withWatermark("at", watermark)
    found = timed.groupBy("entity").transformWithStateInPandas(GapProcessor(over), outputStructType=GAP_SCHEMA, outputMode="Append", timeMode="EventTime")
    return found.select("entity", F.timestamp_micros("gap_start").alias("gap_start"), F.timestamp_micros("gap_end").alias("gap_end"))


Merge = Callable[[DataFrame, DataFrame], DataFrame]


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


class SliceMerge:
    """A table of slices (such as days) into which batches are merged: only the slices that a batch touches are read and
    written again, so the bytes written follow the batch and not the table.

    Every row carries the batch that wrote its slice last. A slice is replaced as a whole (dynamic overwrite), so a batch
    that is replayed after a failure finds the slices that it has finished and leaves them, and merges the others.
    ``merge(old, new)`` gives the rows of slices; both have the columns of ``schema`` (without slice and batch). Rows whose
    slice is null are in one of their own.
    """

    def __init__(self, path: str, schema: str, slice_of: Column, merge: Merge):
        self.path, self.schema, self.merge = path, schema, merge
        self.slice = F.coalesce(slice_of.cast("string"), F.lit("none"))

    def rows(self, spark: SparkSession) -> DataFrame:
        """The table as it is, with ``_batch`` and ``_slice``."""
        schema = f"{self.schema}, _batch long, _slice string"
        return spark.read.schema(schema).parquet(self.path) if _exists(spark, self.path) else spark.createDataFrame([], schema)

    def __call__(self, new: DataFrame, batch_id: int) -> list[str]:
        """Merge a batch; returns the slices that were written."""
        spark = new.sparkSession
        placed = materialize(new.withColumn("_slice", self.slice), "batch")
        held = self.rows(spark)
        touched = [r[0] for r in placed.select("_slice").distinct().collect()]  # one value a slice
        old = held.where(F.col("_slice").isin(touched))
        done = {r[0] for r in old.where(F.col("_batch") >= batch_id).select("_slice").distinct().collect()}
        left = [s for s in touched if s not in done]
        if not left:
            return []
        own = F.col("_slice").isin(left)
        merged = self.merge(old.where(own).drop("_batch", "_slice"), placed.where(own).drop("_slice"))
        # what is written again is read to the end before
        out = materialize(merged.withColumns({"_batch": F.lit(batch_id).cast("long"), "_slice": self.slice}), "merged")
        out.repartition("_slice").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_slice").parquet(self.path)
        return left


class LateRows:
    """A foreachBatch function that keeps what a watermark drops.

    The watermark of a batch is the latest time of the batches before it less the delay, as Spark has it; the latest time
    of each batch is written below ``path``, so that a replay sees the same watermark. Rows in time and late ones go into
    the aggregates by one additive merge, into whatever slices they belong to, and the late rows are written beside them
    (``late``), a folder for each batch.
    """

    def __init__(self, path: str, delay: float, aggregate: Callable[[DataFrame], DataFrame], into: SliceMerge, ts: str = "ts"):
        self.path, self.delay, self.aggregate, self.into, self.ts = path, round(delay * 1_000_000), aggregate, into, ts

    def _marks(self, spark: SparkSession) -> DataFrame:
        path = f"{self.path}/marks"
        schema = "latest long, batch long"
        return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)

    def watermark(self, spark: SparkSession, batch_id: int) -> int | None:
        """Microseconds; None before the first batch."""
        latest = self._marks(spark).where(F.col("batch") < batch_id).agg(F.max("latest")).first()[0]
        return None if latest is None else latest - self.delay

    def late(self, spark: SparkSession, schema: str) -> DataFrame:
        path = f"{self.path}/late"
        return spark.read.schema(f"{schema}, batch long").parquet(path) if _exists(spark, path) else spark.createDataFrame([], f"{schema}, batch long")

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        rows = materialize(df, "rows")
        micros = F.unix_micros(F.col(self.ts).cast("timestamp"))
        mark = self.watermark(spark, batch_id)
        behind = F.coalesce(micros < mark, F.lit(False)) if mark is not None else F.lit(False)
        rows.where(behind).write.mode("overwrite").parquet(f"{self.path}/late/batch={batch_id}")
        self.into(self.aggregate(rows), batch_id)
        rows.agg(F.max(micros).alias("latest")).write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch_id}")


class TargetLog:
    """A foreachBatch function over changes of targets (asset, expires, score, seen) that keeps the live ones and logs what is
    decided of every target that a batch changes, admissions and refusals with their reason, a folder for each batch.

    The batch's time is its latest detection, or that of the batches before it. All live targets are ranked together, by
    range; the log has a row for each changed one.
    """

    def __init__(self, path: str, cap: int, rank: Callable[[DataFrame, float, int], DataFrame]):
        self.path, self.cap, self.rank = path, cap, rank
        newer = lambda old, new: upsert(old, new, ["asset"], "expires")
        self.live = SliceMerge(f"{path}/live", "asset string, expires double, score double, seen double", F.pmod(F.xxhash64("asset"), F.lit(64)), newer)

    def log(self, spark: SparkSession) -> DataFrame:
        schema = "asset string, expires double, score double, seen double, rank long, admitted boolean, reason string, decided_at double, batch long"
        return spark.read.schema(schema).parquet(f"{self.path}/log") if _exists(spark, f"{self.path}/log") else spark.createDataFrame([], schema)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        latest = df.groupBy("asset").agg(F.max_by(F.struct("expires", "score", "seen"), F.struct("seen", "expires")).alias("_l")).select("asset", "_l.*")
        changed = materialize(latest, "changed")
        self.live(changed, batch_id)
        held = self.live.rows(df.sparkSession).drop("_batch", "_slice")
        now = held.agg(F.max("seen")).first()[0]
        if now is None:
            return
        ranked = self.rank(held, now, self.cap).select("asset", F.col("rank").cast("long").alias("rank"), "admitted")
        out = changed.join(ranked, "asset", "left").withColumn("admitted", F.coalesce("admitted", F.lit(False)))
        reason = F.when(F.col("admitted"), "admitted").when(F.col("rank").isNull(), "expired").otherwise("cap reached")
        out.withColumns({"reason": reason, "decided_at": F.lit(float(now))}).write.mode("overwrite").parquet(f"{self.path}/log/batch={batch_id}")
