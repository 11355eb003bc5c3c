"""Moving aggregates whose cost doesn't depend on the length of the frame.

Spark computes a frame that slides at both ends afresh for every row. Here rows are cut into panes as long as the frame,
so that a frame is the end of one pane and the beginning of the next: aggregates that grow from a pane's beginning and
from its end, each a running window, are looked up and united. Counts, means, squared deviations, least and greatest
values unite without differences of large sums, so nothing cancels however long the series is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegauge.functions.time import ORIGIN


def _summary(column: str, w: WindowSpec) -> Column:
    n = F.count(column).over(w)
    return F.struct(n.alias("n"), F.avg(column).over(w).alias("mean"), (F.var_pop(column).over(w) * n).alias("m2"), F.min(column).over(w).alias("least"), F.max(column).over(w).alias("greatest"))


def _united(a: Column, b: Column) -> Column:
    """The summary of two disjoint sets of rows; either may be null or empty."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"), (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"),
        F.least(a["least"], b["least"]).alias("least"), F.greatest(a["greatest"], b["greatest"]).alias("greatest"),
    )
    nothing = lambda s: F.coalesce(s["n"], F.lit(0)) == 0
    return F.when(nothing(a), b).when(nothing(b), a).otherwise(both)


def over_rows(df: DataFrame, by: list[str], order: list[str], column: str, n: int, name: str) -> DataFrame:
    """df with ``name``, the summary (n, mean, m2, least, greatest) of the column's values that aren't null over this row and
    the n - 1 before it. One shuffle by key."""
    w = Window.partitionBy(*by).orderBy(*order)
    placed = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_pane", F.floor(F.col("_i") / n))
    pane = Window.partitionBy(*by, "_pane")
    grown = placed.withColumns({k: _summary(column, pane.orderBy(o).rowsBetween(Window.unboundedPreceding, 0)) for k, o in (("_up", F.asc("_i")), ("_down", F.desc("_i")))})
    # the frame's first row is n - 1 rows up; it is in this pane only where the frame is the whole pane
    earlier = F.when(F.col("_i") % n != n - 1, F.lag("_down", n - 1).over(Window.partitionBy(*by).orderBy("_i")))
    # the first rows' frames begin in no earlier pane
    return grown.withColumn("_earlier", earlier).withColumn(name, _united(F.col("_earlier"), F.col("_up"))).drop("_i", "_pane", "_up", "_down", "_earlier")


def over_time(df: DataFrame, by: list[str], ts: str, column: str, from_seconds: int, to_seconds: int, name: str) -> DataFrame:
    """df with ``name``, the summary of the column's values over the rows whose time lies between ``from_seconds`` and
    ``to_seconds`` before this one's, both included. One shuffle by key; a row with a null time has none."""
    a, b = from_seconds * 1_000_000, to_seconds * 1_000_000
    if a <= b:
        raise ValueError("the frame has to end after it begins")
    placed = df.withColumn("_t", F.timestamp_diff("MICROSECOND", F.expr(ORIGIN), F.col(ts))).withColumn("_pane", F.floor(F.col("_t") / (a - b)))
    pane = Window.partitionBy(*by, "_pane")
    grown = placed.withColumns({k: _summary(column, pane.orderBy(o).rangeBetween(Window.unboundedPreceding, 0)) for k, o in (("_up", F.asc("_t")), ("_down", F.desc("_t")))})
    key = Window.partitionBy(*by)
    # the last row that isn't too young, and the first that isn't too old: frames that only grow
    last = F.last(F.struct("_pane", F.col("_up").alias("s"))).over(key.orderBy("_t").rangeBetween(Window.unboundedPreceding, -b))
    first = F.last(F.struct("_pane", F.col("_down").alias("s"))).over(key.orderBy(F.desc("_t")).rangeBetween(Window.unboundedPreceding, a))
    met = grown.withColumns({"_last": last, "_first": first})
    begins = F.floor((F.col("_t") - a) / (a - b))
    down = F.when(F.col("_first._pane") == begins, F.col("_first.s"))
    up = F.when(F.col("_last._pane") == begins + 1, F.col("_last.s"))
    return met.withColumn(name, F.when(F.col("_t").isNotNull(), _united(down, up))).drop("_t", "_pane", "_up", "_down", "_last", "_first")


def average(summary: str) -> Column:
    """Null where there is no value."""
    return F.when(F.col(f"{summary}.n") > 0, F.col(f"{summary}.mean"))


def deviation(summary: str) -> Column:
    """The sample deviation; null below two values."""
    return F.when(F.col(f"{summary}.n") > 1, F.sqrt(F.col(f"{summary}.m2") / (F.col(f"{summary}.n") - 1)))


def zscore(column: str, summary: str, n: int) -> Column:
    """(x - mean) / sample deviation, null unless the frame has n values and they vary."""
    sd = deviation(summary)
    return F.when((F.col(f"{summary}.n") == n) & (sd > 0), (F.col(column) - F.col(f"{summary}.mean")) / sd)
