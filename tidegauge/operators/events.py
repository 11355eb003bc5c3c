"""Event selection over ordered rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.time import shift
from tidegauge.operators import scan


_BEFORE_ALL = -(1 << 63)


def _accepted(by: list[str], entries: dict[int, int] | None = None, exits: bool = False):
    """A fold over sorted rows of whole keys or, by ``entries``, of ranges: it holds the last accepted end of the current
    key, from which on an event may start, and gives the accepted rows or, for a range, the end that it leaves behind."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, last, part = None, _BEFORE_ALL, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            fresh = np.zeros(n, bool)
            for c in by:
                codes = pc.dictionary_encode(batch.column(c), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                fresh[1:] |= codes[1:] != codes[:-1]
            key = [batch.column(c)[0].as_py() for c in by]
            if part is None and entries is not None:
                part = batch.column("_p")[0].as_py()
                current, last = key, entries.get(part, _BEFORE_ALL)
            fresh[0] = key != current
            current = [batch.column(c)[n - 1].as_py() for c in by]
            kept = np.zeros(n, bool)
            begins, ends = (batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("_s", "_e"))
            for i, (new, begin, end) in enumerate(zip(fresh.tolist(), begins, ends, strict=True)):
                if new or begin >= last:
                    kept[i], last = True, end
            if not exits:
                yield batch.filter(pa.array(kept))
        if exits and part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([last], pa.int64())], names=["_p", "_exit"])

    return fold


def _by_ranges(solid: DataFrame, by: list[str], tie: str) -> DataFrame:
    """The accepted rows of keys that lie in several ranges, each range folded by itself.

    A range starts as if nothing were accepted before it. Then those whose left neighbour leaves behind another end than
    they had started from are folded again, until no end changes. Two folds of a range agree as soon as they accept the
    same event, which they soon do, so a second pass mostly confirms the first. The driver holds two numbers a range.
    """
    order = [*by, "_s", tie]
    parts = int(solid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = scan.dealt(solid, by, ["_s", tie])
    key = F.struct(*by)
    facts = ranges.groupBy("_p").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    told = facts.select("_p", (F.lag("high").over(Window.orderBy("_p")).eqNullSafe(F.col("low"))).alias("goes_on"), (F.col("low") == F.col("high")).alias("single")).orderBy("_p").collect()
    ordered = lambda rows: rows.repartitionById(parts, F.col("_p")).sortWithinPartitions(*order)
    entries: dict[int, int] = {}
    exits: dict[int, int] = {}
    stale = [r["_p"] for r in told]
    while stale:
        found = ordered(ranges.where(F.col("_p").isin(stale))).mapInArrow(_accepted(by, entries, True), "_p int, _exit long").collect()
        exits |= {r["_p"]: r["_exit"] for r in found}
        stale = []
        for left, r in zip(told, told[1:], strict=False):
            entry = exits[left["_p"]] if r["goes_on"] else _BEFORE_ALL
            if entry != entries.get(r["_p"], _BEFORE_ALL):
                entries[r["_p"]] = entry
                # the end that a range of several keys leaves behind is that of its last one
                stale += [r["_p"]] if r["single"] else []
    out = ordered(ranges)
    return out.mapInArrow(_accepted(by, entries), out.schema).drop("_p")


def greedy(df: DataFrame, by: list[str], start: str, end: Column, tie: str, large: int = scan.LARGE) -> DataFrame:
    """Events that start at or after the end of the last accepted one of their key, in order of (start, tie).

    Each key's rows are sorted and stream through one fold that holds the last end only, so a task takes constant memory;
    keys run side by side, and a key of over ``large`` rows is folded by ranges of time side by side. Events with a null
    start or end are left out and block nothing.
    """
    micros = lambda c: F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), c)
    solid = df.withColumns({"_s": micros(F.col(start)), "_e": micros(end)}).where("_s is not null and _e is not null")
    if scan.largest_group(solid, by) > large:
        return _by_ranges(solid, by, tie).drop("_s", "_e")
    ordered = solid.repartition(*by).sortWithinPartitions(*by, "_s", tie)
    return ordered.mapInArrow(_accepted(by), ordered.schema).drop("_s", "_e")


def cooldown(df: DataFrame, by: list[str], seconds: int, ts: str = "ts", tie: str = "id") -> DataFrame:
    """Events at least ``seconds`` after the last accepted one of their key."""
    return greedy(df, by, ts, shift(ts, seconds), tie)


def leader_signals(returns: DataFrame, leaders: dict[str, float], confirmer: str, session: Column, step: int, hold: int) -> DataFrame:
    """Times at which some leader's return reaches its own threshold and the confirmer's is above zero, within the session, and
    exactly one step before that wasn't so; signals within ``hold`` seconds of an accepted one are blocked. returns:
    venue, bucket, ret. The step before is met by equality, so no window holds the whole market."""
    wide = returns.groupBy("bucket").pivot("venue", [*leaders, confirmer]).agg(F.max("ret"))
    led = F.lit(False)
    for name, least in leaders.items():
        led = led | F.coalesce(F.col(name) >= least, F.lit(False))
    hot = wide.select("bucket", F.coalesce(led & (F.col(confirmer) > 0) & session, F.lit(False)).alias("hot"))
    before = hot.select(shift("bucket", step).alias("bucket"), F.col("hot").alias("_was"))
    edges = hot.where("hot").join(before, "bucket").where("not _was").select("bucket", F.lit(0).alias("_market"))
    return cooldown(edges, ["_market"], hold, "bucket", "bucket").drop("_market")


def detect(df: DataFrame, rules: list[tuple[str, Column]], floors: Column) -> DataFrame:
    """Rows that meet the floors and a rule, with the first rule that holds as ``trigger``."""
    trigger = F.coalesce(*(F.when(c, F.lit(name)) for name, c in rules))
    return df.where(floors).withColumn("trigger", trigger).where(F.col("trigger").isNotNull())


def windows_around(events: DataFrame, before: int, after: int, ts: str = "ts") -> DataFrame:
    return events.withColumns({"window_start": shift(ts, -before), "window_end": shift(ts, after)})


def digest_number(digest: Column, first: int) -> Column:
    """Eight bytes of a hexadecimal digest from byte ``first`` on as an unsigned number."""
    return F.conv(F.substring(digest, 2 * first + 1, 16), 16, 10).cast("decimal(20,0)")


def baseline_sample(df: DataFrame, entity: str, day: str, ts: str, rate: float, seed: str) -> DataFrame:
    """At most one row per entity and day, the same at each run: a digest of (seed, entity, day) decides whether there is
    one and which."""
    digest = F.sha2(F.concat_ws("|", F.lit(seed), F.col(entity).cast("string"), F.col(day).cast("string")), 256)
    rows = df.where(F.col(ts).isNotNull()).select(entity, day, ts).withColumn("_d", digest)
    drawn = rows.where(digest_number(F.col("_d"), 0).cast("double") / F.lit(float((1 << 64) - 1)) < rate)
    group = Window.partitionBy(entity, day)
    placed = drawn.withColumns({"_n": F.count("*").over(group), "_r": F.row_number().over(group.orderBy(ts)) - 1})
    return placed.where(F.col("_r") == digest_number(F.col("_d"), 8) % F.col("_n")).select(entity, day, ts)


def cap_per_entity(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each key: the limit is the feature."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def admit(df: DataFrame, kind: str, key: Column, caps: dict[str, int]) -> DataFrame:
    """Every row with ``admitted`` and ``reason``: in order of the key's digest the first rows of a kind up to its cap.

    The cut is the digest of the last admitted row (a top-k), so no global sort is made.
    """
    keyed = df.withColumn("_o", F.sha2(key, 256))
    cut = None
    for name, cap in caps.items():
        top = keyed.where(F.col(kind) == name).orderBy("_o").limit(cap).agg(F.max("_o").alias("_cut")).withColumn("_kind", F.lit(name))
        cut = top if cut is None else cut.unionByName(top)
    out = keyed.join(F.broadcast(cut), keyed[kind] == cut["_kind"], "left")  # one row for each kind
    admitted = F.coalesce(F.col("_o") <= F.col("_cut"), F.lit(False))
    reason = F.when(admitted, "admitted").when(F.col("_cut").isNull(), "no cap").otherwise("cap reached")
    return out.withColumns({"admitted": admitted, "reason": reason}).drop("_o", "_cut", "_kind")


def round_robin(sources: list[DataFrame], item: str, order: str, cap: int) -> DataFrame:
    """Items taken in turn from lists in order of priority, each item once, up to the cap."""
    ranked = None
    for i, s in enumerate(sources):
        top = s.orderBy(order, item).limit(cap).withColumn("_r", F.row_number().over(Window.orderBy(order, item))).select(item, "_r", F.lit(i).alias("_s"))
        ranked = top if ranked is None else ranked.unionByName(top)
    once = ranked.groupBy(item).agg(F.min(F.struct("_r", "_s")).alias("_o"))
    return once.orderBy("_o._r", "_o._s").limit(cap).select(item, F.col("_o._r").alias("turn"), F.col("_o._s").alias("source"))


def chunk_windows(df: DataFrame, minutes: int, start: str = "start", end: str = "end") -> DataFrame:
    """Spans cut into pieces of at most ``minutes`` minutes."""
    seconds = minutes * 60
    length = F.timestamp_diff("SECOND", F.col(start), F.col(end))
    last = F.greatest(F.ceil(length / seconds) - 1, F.lit(0))
    out = df.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return out.withColumn("chunk_start", shift(start, F.col("_k") * seconds)).withColumn("chunk_end", F.least(shift("chunk_start", seconds), F.col(end))).withColumnRenamed("_k", "chunk")


def censor(df: DataFrame, exit_ts: Column, end: Column) -> DataFrame:
    """Events whose exit is not after the end of the study."""
    return df.where(exit_ts <= end)


def first_per_day(df: DataFrame, by: list[str], day: Column, order: list[str]) -> DataFrame:
    return cap_per_entity(df.withColumn("_day", day), [*by, "_day"], order, 1).drop("_day")
