"""Metrics of trades and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.scalars import ratio, wilson
from tidegauge.operators.quantiles import LIMIT, percentiles_of, value_counts
from tidegauge.operators.scratch import materialize


def event_metrics(df: DataFrame, by: list[str], value: str = "net") -> DataFrame:
    """Metrics of each group's event returns. worst_loss_ratio is 0 without a loss; profit_factor null without one."""
    values = value_counts(df, by, value)
    x, n = F.col(value), F.col("_n")
    total = lambda c: F.sum(F.when(c, x * n))
    count = lambda c: F.sum(F.when(c, n))
    mean = F.sum(x * n) / F.sum(n)
    facts = values.groupBy(*by).agg(
        F.sum(n).alias("n"),
        mean.alias("mean"),
        (F.coalesce(count(x > 0), F.lit(0)) / F.sum(n)).alias("hit_rate"),
        ratio(F.coalesce(total(x > 0), F.lit(0.0)), -total(x < 0)).alias("profit_factor"),
        F.min(x).alias("worst"),
        (total(x > 0) / count(x > 0)).alias("avg_winner"),
        (total(x < 0) / count(x < 0)).alias("avg_loser"),
    )
    # the deviation is summed around the mean, so that it keeps its digits
    spread = values.join(facts.select(*by, "mean"), by).groupBy(*by).agg(F.sum(n * (x - F.col("mean")) ** 2).alias("_ss"))
    sd = F.when(F.col("n") > 1, F.sqrt(F.col("_ss") / (F.col("n") - 1))).alias("sd")
    out = facts.join(spread, by).join(percentiles_of(values, by, value, {"median": 0.5}), by)
    worst_ratio = F.when(F.col("worst") >= 0, 0.0).otherwise(ratio(-F.col("worst"), "avg_winner")).alias("worst_loss_ratio")
    return out.select(*by, "n", "mean", "median", "hit_rate", "profit_factor", "worst", "avg_winner", "avg_loser", worst_ratio, sd)


def path_metrics(trades: DataFrame, by: list[str], value: str = "net", ts: str = "ts", ties: tuple[str, ...] = ("id", "net")) -> DataFrame:
    """n_dates, drawdown (of the running sum below its highest point, which is 0 at least), losing_streak (rows below zero in
    a row) and longest_gap in seconds of each group in order of (ts, ties).

    Each day of a group is a sorted pass of its own; the days are stitched by their totals, extremes and ends, so that a
    group of any size is spread over tasks.
    """
    x, day = F.col(value), "_day"
    dated = trades.withColumn(day, F.to_date(ts))
    w = Window.partitionBy(*by, day).orderBy(ts, *ties)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    lost = x < 0
    ran = dated.withColumns({"_sum": F.sum(value).over(upto), "_gap": F.timestamp_diff("SECOND", F.lag(ts).over(w), F.col(ts)), "_i": F.row_number().over(w), "_block": F.sum(F.when(lost, 0).otherwise(1)).over(upto)})
    # losses since the last row that wasn't one
    since = F.col("_i") - F.coalesce(F.max(F.when(lost, F.lit(None)).otherwise(F.col("_i"))).over(upto), F.lit(0))
    ran = ran.withColumns({"_high": F.max("_sum").over(upto), "_run": since})
    last = F.struct(ts, *ties)
    days = ran.groupBy(*by, day).agg(
        F.count("*").alias("_n"), F.sum(value).alias("_total"), F.min("_sum").alias("_low"), F.max("_sum").alias("_top"), F.min(F.col("_sum") - F.col("_high")).alias("_inner"),
        F.max("_run").alias("_streak"), F.max(F.when(F.col("_block") == 0, F.col("_run"))).alias("_lead"), F.max_by("_run", last).alias("_tail"), F.max("_block").alias("_kept"),
        F.max("_gap").alias("_gap"), F.min(ts).alias("_first"), F.max(ts).alias("_last"),
    )
    s = Window.partitionBy(*by).orderBy(day)
    earlier = s.rowsBetween(Window.unboundedPreceding, -1)
    whole = F.col("_kept") == 0  # every row of the day is a loss
    at = days.withColumns({"_sum0": F.coalesce(F.sum("_total").over(earlier), F.lit(0.0)), "_part": F.sum(F.when(whole, 0).otherwise(1)).over(s.rowsBetween(Window.unboundedPreceding, 0)), "_wait": F.timestamp_diff("SECOND", F.lag("_last").over(s), F.col("_first"))})
    at = at.withColumns({
        "_peak0": F.greatest(F.lit(0.0), F.max(F.col("_sum0") + F.col("_top")).over(earlier)),
        "_carried": F.sum(F.when(whole, F.col("_n")).otherwise(F.col("_tail"))).over(Window.partitionBy(*by, "_part").orderBy(day).rowsBetween(Window.unboundedPreceding, 0)),
    })
    at = at.withColumn("_run", F.coalesce(F.lag("_carried").over(s), F.lit(0)) + F.when(whole, F.col("_n")).otherwise(F.coalesce("_lead", F.lit(0))))
    below = F.least(F.col("_inner"), F.col("_sum0") + F.col("_low") - F.col("_peak0"), F.lit(0.0))
    return at.groupBy(*by).agg(
        F.count("*").alias("n_dates"), F.min(below).alias("drawdown"), F.max(F.greatest("_streak", "_run")).cast("long").alias("losing_streak"), F.max(F.greatest("_gap", "_wait")).alias("longest_gap")
    )


SHARES = {"median": 0.5, "p05": 0.05, "p01": 0.01, "median_winner": 0.5, "median_loser": 0.5}


def trade_metrics(trades: DataFrame, by: list[str], value: str = "net", ts: str = "ts", symbol: str = "symbol", ties: tuple[str, ...] = ("id", "net"), near: float = 0.1, limit: int = LIMIT) -> DataFrame:
    """The thirty metrics of each group of trades with columns value, ts, symbol, mae, mfe, concurrency and the ties.

    profit_factor is infinite without losses; worst_loss 0 without one; worst_loss_ratio null without winners; losers_near
    is the share of losses of at most ``near`` average winners (1 without losses). The columns that count are written once
    and read three times: sums by symbol, from which the groups' follow; percentiles, of counted values and by range where
    a group has over ``limit`` trades; and the path.
    """
    x = F.col(value)
    held = [*by, symbol, ts, value, *ties, "mae", "mfe", "concurrency"]
    trades = materialize(trades.select(*dict.fromkeys(held)), "trades")
    when = lambda c, v=None: F.count_if(c) if v is None else F.sum(F.when(c, v))
    known = trades.where(x.isNotNull())
    per_symbol = materialize(trades.groupBy(*by, symbol).agg(
        F.count("*").alias("_c"), F.count(x).alias("n"), when(x > 0).alias("wins"), when(x < 0).alias("losses"), when(x == 0).alias("flats"), F.sum(x).alias("total"), when(x > 0, x).alias("_gain"), when(x < 0, x).alias("_loss"),
        F.min(F.when(x < 0, x)).alias("_worst"), F.min("mae").alias("mae"), F.max("mfe").alias("mfe"), F.max("concurrency").alias("max_concurrency"), F.sum("concurrency").alias("_conc"), F.count("concurrency").alias("_has"),
    ), "symbols")
    sums = [F.sum(c).alias(c) for c in ("n", "wins", "losses", "flats", "total", "_gain", "_loss")]
    facts = per_symbol.groupBy(*by).agg(
        *sums, F.min("_worst").alias("_worst"), F.count("*").alias("n_symbols"), F.max("_c").alias("most_of_one_symbol"), F.min("mae").alias("worst_mae"), F.max("mfe").alias("best_mfe"),
        F.max("max_concurrency").alias("max_concurrency"), F.try_divide(F.sum("_conc"), F.sum("_has")).alias("avg_concurrency"),
    )
    facts = facts.where("n > 0").withColumns({"avg_winner": F.try_divide("_gain", "wins"), "avg_loser": F.try_divide("_loss", "losses"), "worst_loss": F.coalesce("_worst", F.lit(0.0))})
    lost = -x <= F.lit(near) * F.col("avg_winner")
    within = {"median_winner": x > 0, "median_loser": x < 0}
    judged = known.join(facts.select(*by, "avg_winner"), by)
    if (facts.agg(F.max("n")).first()[0] or 0) <= limit:
        free = [k for k in SHARES if k not in within]
        own = [F.percentile(F.when(c, x), F.lit(SHARES[k])).alias(k) for k, c in within.items()]
        met = judged.groupBy(*by).agg(F.percentile(x, F.array(*(F.lit(SHARES[k]) for k in free))).alias("_q"), *own, F.count_if((x < 0) & lost).alias("_close"))
        points = met.select(*by, *(F.col("_q")[k].alias(name) for k, name in enumerate(free)), *within, "_close")
    else:
        points = percentiles_of(value_counts(known, by, value), by, value, SHARES, within)
        points = points.join(judged.groupBy(*by).agg(F.count_if((x < 0) & lost).alias("_close")), by)
    out = facts.join(points, by).join(path_metrics(trades, by, value, ts, ties), by)
    low, high = wilson("wins", "n", 1.959963984540054)
    won = F.col("avg_winner") > 0
    return out.select(
        *by, "n", "wins", "losses", "flats", "n_symbols", "n_dates", "most_of_one_symbol",
        (F.col("wins") / F.col("n")).alias("hit_rate"), low.alias("hit_low"), high.alias("hit_high"), (F.col("total") / F.col("n")).alias("mean"), "median", "avg_winner", "median_winner", "avg_loser", "median_loser",
        F.when(F.col("losses") > 0, F.coalesce("_gain", F.lit(0.0)) / -F.col("_loss")).when(F.col("wins") > 0, F.lit(float("inf"))).alias("profit_factor"),
        "worst_loss", "p05", "p01", "worst_mae", "best_mfe", F.when(won, -F.col("worst_loss") / F.col("avg_winner")).alias("worst_loss_ratio"),
        F.when((F.col("losses") > 0) & won, F.col("_close") / F.col("losses")).when(F.col("losses") == 0, 1.0).alias("losers_near"),
        "total", "drawdown", "losing_streak", "longest_gap", "max_concurrency", "avg_concurrency",
    )


def cluster_means(df: DataFrame, by: list[str], cluster: list[str], value: str) -> DataFrame:
    """Mean, sample deviation, number and z of the clusters' means."""
    means = df.where(F.col(value).isNotNull()).groupBy(*by, *cluster).agg(F.avg(value).alias("_m"))
    out = means.groupBy(*by).agg(F.avg("_m").alias("mean"), F.stddev_samp("_m").alias("sd"), F.count("*").alias("clusters"))
    return out.withColumn("z", z_of("mean", "sd", "clusters"))


def z_of(mean: str, sd: str, n: str) -> Column:
    """mean / (sd / sqrt(n)); null for n <= 1 or sd <= 0."""
    return F.when((F.col(n) > 1) & (F.col(sd) > 0), F.col(mean) / (F.col(sd) / F.sqrt(F.col(n))))


def daily_t(df: DataFrame, by: list[str], day: Column, value: str) -> DataFrame:
    """Statistics of the daily means and their plain t."""
    return cluster_means(df.withColumn("_day", day), by, ["_day"], value)


def leave_out(trades: DataFrame, group: str, value: str = "net") -> DataFrame:
    """Metrics without each group in turn, as totals less the group's sums: one aggregation over the trades."""
    x = F.col(value)
    sums = trades.groupBy(group).agg(F.count(x).alias("_n"), F.sum(x).alias("_s"), F.count_if(x > 0).alias("_w"))
    total = sums.agg(F.sum("_n").alias("n_all"), F.sum("_s").alias("s_all"), F.sum("_w").alias("w_all"))
    joined = sums.crossJoin(F.broadcast(total))  # one row
    n = F.col("n_all") - F.col("_n")
    return joined.select(
        F.col(group).alias("left_out"), n.alias("n"), F.try_divide(F.col("s_all") - F.col("_s"), n).alias("mean"), F.try_divide(F.col("w_all") - F.col("_w"), n).alias("hit_rate")
    )


def concentration(trades: DataFrame, by: list[str], group: str, value: str = "net", k: int = 2) -> DataFrame:
    """by, worst_left_out (the least mean without one of the groups), mean_rest and hit_rest without the k groups of most
    rows (ties by name), and concentration_ok: all means above zero and over half of the rest won. One aggregation over
    the trades; a group of ``by`` without other rows isn't ok."""
    x = F.col(value)
    sums = trades.groupBy(*by, group).agg(F.count(x).alias("_n"), F.sum(x).alias("_s"), F.count_if(x > 0).alias("_w"))
    whole = sums.groupBy(*by).agg(F.sum("_n").alias("_an"), F.sum("_s").alias("_as"))
    first = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("n"), F.col(group).alias("g"), F.col("_s").alias("s"), F.col("_w").alias("w")))), 1, k)
    # the k largest of each group are picked in two steps, so that no list grows with the groups
    parts = sums.groupBy(*by, F.pmod(F.xxhash64(group), F.lit(256)).alias("_p")).agg(first.alias("_l"))
    top = parts.select(*by, F.explode("_l").alias("_x")).groupBy(*by).agg(F.slice(F.array_sort(F.collect_list("_x")), 1, k).alias("_top"))
    out = sums.join(whole, by).groupBy(*by).agg(
        F.min(F.try_divide(F.col("_as") - F.col("_s"), F.col("_an") - F.col("_n"))).alias("worst_left_out"), F.sum("_n").alias("_an"), F.sum("_s").alias("_as"), F.sum("_w").alias("_aw")
    )
    taken = lambda c, zero: F.aggregate("_top", F.lit(zero), lambda a, x: a + x[c])
    out = out.join(top, by).withColumn("_rest", F.col("_an") + F.aggregate("_top", F.lit(0).cast("long"), lambda a, x: a + x["n"]))
    out = out.withColumns({"mean_rest": F.try_divide(F.col("_as") - taken("s", 0.0), "_rest"), "hit_rest": F.try_divide(F.col("_aw") - F.aggregate("_top", F.lit(0).cast("long"), lambda a, x: a + x["w"]), "_rest")})
    ok = (F.col("worst_left_out") > 0) & (F.col("mean_rest") > 0) & (F.col("hit_rest") > 0.5)
    return out.select(*by, "worst_left_out", "mean_rest", "hit_rest", F.coalesce(ok, F.lit(False)).alias("concentration_ok"))


def top_groups(trades: DataFrame, group: str, k: int = 2) -> DataFrame:
    """The k groups with most rows, ties by name."""
    return trades.groupBy(group).agg(F.count("*").alias("n")).orderBy(F.desc("n"), group).limit(k)


def cost_stress(trades: DataFrame, costs_bp: list[float], gross: str = "gross") -> DataFrame:
    """Every trade once for each cost, with its net return."""
    return trades.withColumn("cost_bp", F.explode(F.array(*(F.lit(float(c)) for c in costs_bp)))).withColumn("net", F.col(gross) - F.col("cost_bp") / 10_000)
