"""Checks of data: contracts, reconciliation, coverage, readiness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.time import shift

SEVERITIES = ("info", "warning", "error")


def contracts(df: DataFrame, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """check, severity, violations of each rule in one pass; a row of which the condition is unknown violates it."""
    counts = df.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(name) for name, (_, c) in rules.items()))
    rows = [F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"), F.col(n).alias("violations")) for n, (s, _) in rules.items()]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def enforce(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """df, failing when a row that breaks a rule is read."""
    for name, c in rules.items():
        df = df.where(F.coalesce(c, F.lit(False)) | F.raise_error(F.lit(f"contract {name} is broken")).cast("boolean"))
    return df


def gate(checks: DataFrame, by: list[str] | None = None) -> DataFrame:
    """fail with a violated error, review with a violated warning, else pass."""
    broken = lambda s: F.coalesce(F.bool_or((F.col("severity") == s) & (F.col("violations") > 0)), F.lit(False))
    verdict = F.when(broken("error"), "fail").when(broken("warning"), "review").otherwise("pass")
    return checks.groupBy(*(by or [])).agg(verdict.alias("verdict"), F.sum("violations").alias("violations"))


def extents(df: DataFrame, by: list[str], ts: str) -> DataFrame:
    """Rows, first and last time and their SHA-256 fingerprint."""
    out = df.groupBy(*by).agg(F.count("*").alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return out.withColumn("fingerprint", F.sha2(F.concat_ws("|", F.col("rows").cast("string"), text("first_ts"), text("last_ts")), 256))


def reconcile(manifest: DataFrame, df: DataFrame, by: list[str], expected: str = "expected") -> DataFrame:
    """Expected against stored rows per key, either side missing counting 0."""
    stored = df.groupBy(*by).agg(F.count("*").alias("stored"))
    joined = manifest.join(stored, by, "full")
    return joined.withColumns({expected: F.coalesce(expected, F.lit(0)), "stored": F.coalesce("stored", F.lit(0))}).withColumn("matches", F.col(expected) == F.col("stored"))


def duplicate_audit(df: DataFrame, key: list[str], payload: list[str]) -> DataFrame:
    """Keys that occur more than once: how often, and with how many different payloads."""
    return df.groupBy(*key).agg(F.count("*").alias("rows"), F.count_distinct(F.struct(*payload)).alias("versions")).where("rows > 1").withColumn("conflicting", F.col("versions") > 1)


def calendar_gaps(df: DataFrame, by: list[str], day: Column, first: str, last: str) -> DataFrame:
    """Every key and day from first to last with its rows."""
    days = df.select(*by).distinct().withColumn("day", F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))))
    counts = df.groupBy(*by, day.alias("day")).agg(F.count("*").alias("rows"))
    return days.join(counts, [*by, "day"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def stacked(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


INTEGRITY = (
    "no look-ahead", "signal known at bar end", "entry after signal", "contemporaneous ranks", "rolling without future", "delisted entities present", "liquidity before signal",
    "hedge prices at exact times", "exact costs", "no overlapping trades", "complete bars only", "frozen thresholds", "coverage",
)


def integrity_checks(bars: DataFrame, signals: DataFrame, trades: DataFrame, end: Column, step: int, full: int, limit: float, min_days: int, window: int = 3, before: int = 6) -> DataFrame:
    """number, check and violations of the thirteen checks of a study, each recomputed from the rows.

    bars: entity, bucket, value, volume, n. signals: entity, bucket, signal_ts, value, rank (percent rank of value over all
    bars of the bucket), rolled (sum of the last ``window`` values), liquidity (mean volume of the ``before`` bars before
    this one). trades: entity, bucket, signal_ts, entry_ts, exit_ts, gross, cost, net, hedge_entry, hedge_exit. A signal
    lies before ``end`` and has a value of at most ``limit``; a whole bar has ``full`` rows.
    """
    key, w = ["entity", "bucket"], Window.partitionBy("entity").orderBy("bucket")
    c = F.col
    # totals up to a row give the window sums by differences, which don't share a frame with what is checked
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    again = bars.withColumns({"_r": F.percent_rank().over(Window.partitionBy("bucket").orderBy("value")), "_v": F.sum("value").over(upto), "_q": F.sum("volume").over(upto), "_i": F.row_number().over(w)})
    back = lambda name, k: F.coalesce(F.lag(name, k).over(w), F.lit(0.0))
    had = F.least(c("_i") - 1, F.lit(before))
    again = again.select(*key, "n", c("_r"), (c("_v") - back("_v", window)).alias("_roll"), F.when(had > 0, (back("_q", 1) - back("_q", before + 1)) / had).alias("_liq"))
    s = signals.join(again, key, "left")
    differs = lambda a, b: (a.isNull() != b.isNull()) | F.coalesce(F.abs(a - b) > 1e-9, F.lit(False))
    from_signals = s.agg(
        F.count_if(c("bucket") >= end).alias("1"), F.count_if(c("signal_ts") != shift("bucket", step)).alias("2"), F.count_if(differs(c("rank"), c("_r"))).alias("4"),
        F.count_if(differs(c("rolled"), c("_roll"))).alias("5"), F.count_if(differs(c("liquidity"), c("_liq"))).alias("7"), F.count_if(~F.coalesce(c("value") <= limit, F.lit(False))).alias("12"),
    )
    reach = F.max("exit_ts").over(Window.partitionBy("entity").orderBy("entry_ts", "exit_ts").rowsBetween(Window.unboundedPreceding, -1))
    t = trades.withColumn("_reach", reach).join(bars.select(*key, c("n")), key, "left")
    from_trades = t.agg(
        F.count_if(c("entry_ts") <= c("signal_ts")).alias("3"), F.count_if(c("hedge_entry").isNull() | c("hedge_exit").isNull()).alias("8"), F.count_if(F.abs(c("net") - (c("gross") - c("cost"))) > 1e-12).alias("9"),
        F.count_if(c("entry_ts") < c("_reach")).alias("10"), F.count_if(F.coalesce(c("n") < full, F.lit(True))).alias("11"),
    )
    absent = bars.select("entity").distinct().join(signals.select("entity").distinct(), "entity", "left_anti").agg(F.count("*").alias("6"))
    days = bars.agg(F.greatest(F.lit(0), F.lit(min_days) - F.count_distinct(F.to_date("bucket"))).cast("long").alias("13"))
    wide = from_signals.crossJoin(from_trades).crossJoin(absent).crossJoin(days)  # one row each
    rows = F.array(*(F.struct(F.lit(i).alias("number"), F.lit(name).alias("check"), c(str(i)).alias("violations")) for i, name in enumerate(INTEGRITY, 1)))
    return wide.select(F.explode(rows).alias("_x")).select("_x.*")
