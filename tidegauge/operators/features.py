"""Rolling and lagged features over ordered rows of a key, with guards against gaps."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegauge.functions.scalars import change, ratio
from tidegauge.functions.time import seconds_between, shift


def series(by: list[str], ts: str = "bucket", *ties: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(ts, *ties)


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    """The current row and the n - 1 before it."""
    return w.rowsBetween(1 - n, 0)


def contiguous(w: WindowSpec, ts: str, k: int, step: int) -> Column:
    """Whether the row k places before is exactly k steps of ``step`` seconds earlier."""
    return F.lag(ts, k).over(w) == shift(ts, -k * step)


def guarded(value: Column, w: WindowSpec, ts: str, k: int, step: int) -> Column:
    """The value, null where the k rows before have a gap."""
    return F.when(contiguous(w, ts, k, step), value)


def lag_returns(w: WindowSpec, lags: dict[str, int], close: str = "close", ts: str | None = None, step: int = 0) -> dict[str, Column]:
    """Returns over k rows; with ``ts`` and ``step`` null across gaps."""
    out = {}
    for name, k in lags.items():
        r = change(close, F.lag(close, k).over(w))
        out[name] = guarded(r, w, ts, k, step) if ts else r
    return out


def full_window(value: Column, anchor: str, w: WindowSpec, n: int) -> Column:
    """The value of a frame of n rows, null while it has fewer with a value."""
    return F.when(F.count(anchor).over(last_rows(w, n)) == n, value)


def zscore(column: str, w: WindowSpec, n: int) -> Column:
    """(x - mean) / sample deviation over the last n rows, null unless all are there and vary."""
    frame = last_rows(w, n)
    sd = F.stddev_samp(column).over(frame)
    return F.when((F.count(column).over(frame) == n) & (sd > 0), (F.col(column) - F.avg(column).over(frame)) / sd)


def trailing_average(column: str, by: list[str], ts: str, from_seconds: int, to_seconds: int) -> Column:
    """Average over the rows whose time lies between ``from_seconds`` and ``to_seconds`` before this one's."""
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col(ts))
    w = Window.partitionBy(*by).orderBy(micros).rangeBetween(-from_seconds * 1_000_000, -to_seconds * 1_000_000)
    return F.avg(column).over(w)


def asof_value(column: str, by: list[str], ts: str, seconds: int) -> Column:
    """The latest value at least ``seconds`` before this row's time."""
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col(ts))
    w = Window.partitionBy(*by).orderBy(micros).rangeBetween(Window.unboundedPreceding, -seconds * 1_000_000)
    return F.last(column, ignorenulls=True).over(w)


def relative_volume(volume: str, w: WindowSpec, recent: int = 5, back: int = 35, least: int = 5) -> Column:
    """Volume of the last ``recent`` rows over ``recent`` times the median positive volume of the rows before them, of
    which there have to be ``least``."""
    positive = F.when(F.col(volume) > 0, F.col(volume))
    before = w.rowsBetween(1 - back, -recent)
    usual = F.percentile(positive, F.lit(0.5)).over(before)
    enough = F.count(positive).over(before) >= least
    return F.when(enough, ratio(F.sum(volume).over(last_rows(w, recent)), usual * recent))


def dollar_volume(w: WindowSpec, n: int = 5, close: str = "close", volume: str = "volume") -> Column:
    return F.sum(F.col(close) * F.col(volume)).over(last_rows(w, n))


def session_return(by: list[str], session: Column, ts: str = "bucket", o: str = "open", c: str = "close") -> Column:
    """Close over the session's first open, less one."""
    return change(c, F.first(o).over(Window.partitionBy(*by, session).orderBy(ts)))


def rising_edge(condition: Column, w: WindowSpec, ts: str, step: int) -> Column:
    """Condition true now and, exactly one step before, not true; without that row it is no edge."""
    before = F.lag(F.coalesce(condition, F.lit(False)), 1).over(w)
    return F.coalesce(condition, F.lit(False)) & contiguous(w, ts, 1, step) & ~before


def exact_lag(df: DataFrame, by: list[str], ts: str, seconds: int, columns: list[str], suffix: str, how: str = "left", of: DataFrame | None = None) -> DataFrame:
    """Rows with the columns of their key's row of ``of`` (df itself if not given) exactly ``seconds`` earlier: an
    equi-join on the shifted time."""
    past = (df if of is None else of).select(*by, shift(ts, seconds).alias(ts), *(F.col(c).alias(f"{c}{suffix}") for c in columns))
    return df.join(past, [*by, ts], how)


def merge_intervals(df: DataFrame, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Overlapping and touching spans of a key merged, with the number of spans in each."""
    w = Window.partitionBy(*by).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col(start) > reach, 1).otherwise(0)
    numbered = df.withColumn("_g", F.sum(fresh).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "_g").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("spans")).drop("_g")


def gaps(df: DataFrame, by: list[str], ts: str = "ts", over: float = 0.0) -> DataFrame:
    """Silent intervals of a key longer than ``over`` seconds."""
    before = F.lag(ts).over(series(by, ts))
    out = df.select(*by, before.alias("gap_start"), F.col(ts).alias("gap_end"))
    return out.withColumn("gap_seconds", seconds_between("gap_start", "gap_end")).where(F.col("gap_seconds") > over)


def islands(df: DataFrame, by: list[str], order: list[str], flag: Column) -> DataFrame:
    """Runs of consecutive rows for which the flag holds: first, last and length."""
    w, own = Window.partitionBy(*by).orderBy(*order), Window.partitionBy(*by, "_f").orderBy(*order)
    marked = df.withColumn("_f", flag)
    marked = marked.withColumn("_g", F.row_number().over(w) - F.row_number().over(own)).where("_f")
    return marked.groupBy(*by, "_g").agg(F.min(order[0]).alias("first"), F.max(order[0]).alias("last"), F.count("*").alias("length")).drop("_g")


def concurrency(df: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Every span with the number of its key's spans that hold at its start, itself included: one sweep over starts and ends."""
    starts = df.select(*by, F.col(start).alias("_t"), F.lit(1).alias("_d"), F.struct(*df.columns).alias("_r"))
    ends = df.select(*by, F.col(end).alias("_t"), F.lit(-1).alias("_d"))
    swept = starts.unionByName(ends, allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy("_t")  # rows of one time count together
    return swept.withColumn("concurrent", F.sum("_d").over(w)).where(F.col("_r").isNotNull()).select("_r.*", "concurrent")


