"""As-of and interval joins as one sorted pass over the union of both sides, or on bounded time cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.time import ORIGIN, seconds_between
from tidegauge.operators import scan


def _stacked(left: DataFrame, right: DataFrame, by: list[str], values: list[str], ts: str, tie: str, right_last: bool) -> DataFrame:
    """Rows of both sides with (key, time, side, tie); a right row's payload is a struct, null on left rows."""
    payload = F.struct(F.col(ts).alias("ts"), *(F.col(v).alias(v) for v in values))
    kept = F.struct(*left.columns)
    own = left.select(*by, F.col(ts).alias("_t"), F.lit(0 if right_last else 1).alias("_side"), F.col(tie).alias("_tie"), kept.alias("_l"))
    other = right.select(*by, F.col(ts).alias("_t"), F.lit(1 if right_last else 0).alias("_side"), F.col(tie).alias("_tie"), payload.alias("_r"))
    return own.unionByName(other, allowMissingColumns=True)


def _carried(stacked: DataFrame, by: list[str], backward: bool, large: int) -> DataFrame:
    """The left rows of the stack with ``_f``, the last right row before them in the order (backward: after them).

    Where a key has more than ``large`` rows its ranges of time go to many tasks, and each is handed the right row that
    the ranges before it end with.
    """
    order = ["_t", "_side", "_tie"]
    if scan.largest_group(stacked, by) > large:
        found = scan.scanned(scan.dealt(stacked, by, order, backward), by, order, F.col("_r"), "_f", "last", backward)
    else:
        w = Window.partitionBy(*by).orderBy(*(F.desc(c) if backward else F.asc(c) for c in order)).rowsBetween(Window.unboundedPreceding, 0)
        found = stacked.withColumn("_f", F.last("_r", ignorenulls=True).over(w))
    return found.where(F.col("_l").isNotNull())


def asof_backward(
    left: DataFrame, right: DataFrame, by: list[str], values: list[str], tolerance: float | None = None, ts: str = "ts", tie: str = "id", prefix: str = "q_", large: int = scan.LARGE,
) -> DataFrame:
    """Every left row with the latest right row of its key at or before its time, and its age in seconds.

    Of right rows at one time that with the largest tie counts. Beyond the tolerance (in seconds) the values are null.
    One shuffle on the key and one sort; no row of a pair is made that isn't returned. A key of over ``large`` rows is
    split by time (see ``scan``), so it may hold any share of the rows.
    """
    stacked = _stacked(left, right, by, values, ts, tie, right_last=False)
    found = _carried(stacked, by, False, large)
    age = seconds_between("_f.ts", "_t")
    hit = F.col("_f").isNotNull() & (age <= tolerance if tolerance is not None else F.lit(True))
    return found.select("_l.*", *(F.when(hit, F.col(f"_f.{v}")).alias(f"{prefix}{v}") for v in values), F.when(hit, age).alias(f"{prefix}age"))


def asof_forward(
    left: DataFrame, right: DataFrame, by: list[str], values: list[str], tolerance: float | None = None, ts: str = "ts", tie: str = "id", prefix: str = "q_", large: int = scan.LARGE,
) -> DataFrame:
    """Every left row with the first right row of its key at or after its time, and the wait in seconds; the mirror of
    ``asof_backward``."""
    stacked = _stacked(left, right, by, values, ts, tie, right_last=True)
    found = _carried(stacked, by, True, large)
    wait = seconds_between("_t", "_f.ts")
    hit = F.col("_f").isNotNull() & (wait <= tolerance if tolerance is not None else F.lit(True))
    return found.select("_l.*", *(F.when(hit, F.col(f"_f.{v}")).alias(f"{prefix}{v}") for v in values), F.when(hit, wait).alias(f"{prefix}wait"))


def in_force(states: DataFrame, by: list[str], ts: str = "ts", tie: str = "id") -> DataFrame:
    """States with their validity [from_ts, to_ts); the last one's to_ts is null."""
    w = Window.partitionBy(*by).orderBy(ts, tie)
    return states.withColumns({"from_ts": F.col(ts), "to_ts": F.lead(ts).over(w)})


#: Cells of a span up to which each is listed.
SHORT = 4


def _dyadic(first: Column, last: Column) -> Column:
    """The cells first to last as (level, cell) of aligned runs of 2**level cells, two a level at most; short spans cell by cell."""
    begins = lambda k: F.ceil(first / F.pow(F.lit(2.0), k)).cast("long")
    ends = lambda k: F.floor((last + 1) / F.pow(F.lit(2.0), k)).cast("long")
    run = lambda k, cell: F.struct(k.cast("int").alias("level"), cell.alias("cell"))
    odd = lambda n: F.pmod(n, F.lit(2)) == 1
    highest = F.ceil(F.log2((last - first + 2).cast("double"))).cast("int")
    levels = F.sequence(F.lit(0), highest)
    left = F.transform(levels, lambda k: F.when((begins(k) < ends(k)) & odd(begins(k)), run(k, begins(k))))
    right = F.transform(levels, lambda k: F.when((begins(k) < ends(k)) & odd(ends(k)), run(k, ends(k) - 1)))
    each = F.transform(F.sequence(first, last), lambda c: run(F.lit(0), c))
    return F.when(last - first < SHORT, each).otherwise(F.array_compact(F.concat(left, right)))


def interval_join(points: DataFrame, spans: DataFrame, by: list[str], cell: int, ts: str = "ts", start: str = "start", end: str = "end", how: str = "inner", closed: bool = True) -> DataFrame:
    """Points within spans of their key: [start, end], or [start, end) unless closed. Spans that end before they start hold
    none.

    An equi-join on (key, level, cell) that makes each pair once. A span of up to SHORT cells of ``cell`` seconds is listed
    once for each; a longer one as runs of 2**level cells, of which there are two a level at most, so spans of seconds and
    of years stand side by side. A point is listed once for each level that occurs.
    """
    number = lambda c: F.floor(seconds_between(F.expr(ORIGIN), c) / cell)
    sound = spans.where(F.col(end) >= F.col(start))
    longest = sound.agg(F.max(number(end) - number(start) + 1)).first()[0] or 0
    listed = sound.withColumn("_run", F.explode(_dyadic(number(start), number(end))))
    top = 0 if longest <= SHORT else math.ceil(math.log2(longest + 1))
    levels = F.array(*(F.lit(k) for k in range(top + 1)))
    runs = F.transform(levels, lambda k: F.struct(k.alias("level"), F.floor(number(ts) / F.pow(F.lit(2.0), k)).cast("long").alias("cell")))
    placed = points.withColumn("_run", F.explode(runs))
    inside = (F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(end) if closed else F.col(ts) < F.col(end))
    p, s = placed.alias("p"), listed.alias("s")
    condition = (F.col("p._run.level") == F.col("s._run.level")) & (F.col("p._run.cell") == F.col("s._run.cell")) & inside
    for k in by:
        condition = (F.col(f"p.{k}") == F.col(f"s.{k}")) & condition
    out = p.join(s, condition, how)
    return out.select("p.*", *(f"s.{c}" for c in spans.columns if c not in by)).drop("_run")


def month_lookup(facts: DataFrame, monthly: DataFrame, by: list[str], ts: str = "ts", month: str = "month") -> DataFrame:
    """Facts with the row of their key and month, if there is one."""
    return facts.withColumn(month, F.trunc(F.col(ts).cast("date"), "month")).join(monthly, [*by, month], "left")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key equals a null key."""
    r = right.select(*(F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns))
    condition: Column = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(r[f"_r_{k}"])
    return left.join(r, condition, how).drop(*(f"_r_{k}" for k in keys))
