"""What follows an event: exact-horizon returns, hedged outcomes, paths, sweeps of a book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.scalars import change
from tidegauge.functions.time import seconds_between, shift


def forward_outcomes(df: DataFrame, by: list[str], ts: str, horizons: list[int], entry: str, exit: str, prices: DataFrame | None = None) -> DataFrame:
    """One row per event and horizon for which the key has a row at exactly ts + horizon seconds: entry and exit value,
    exit time and gross return. An equi-join on the shifted time, which the events reach once per horizon."""
    later = (prices if prices is not None else df).select(*by, F.col(ts).alias("exit_ts"), F.col(exit).alias("exit_value"))
    wide = df.withColumn("horizon", F.explode(F.array(*map(F.lit, horizons)))).withColumn("exit_ts", shift(ts, F.col("horizon")))
    return wide.join(later, [*by, "exit_ts"]).withColumns({"entry_value": F.col(entry), "gross": change("exit_value", entry)})


def crossing_returns(df: DataFrame, by: list[str], ts: str, horizons: list[int], bid: str = "bid", ask: str = "ask") -> DataFrame:
    """Long returns from ask to bid and short ones from bid to ask, with both spreads in basis points."""
    later = df.select(*by, F.col(ts).alias("exit_ts"), F.col(bid).alias("exit_bid"), F.col(ask).alias("exit_ask"))
    wide = df.withColumn("horizon", F.explode(F.array(*map(F.lit, horizons)))).withColumn("exit_ts", shift(ts, F.col("horizon")))
    bps = lambda b, a: (F.col(a) - F.col(b)) / ((F.col(a) + F.col(b)) / 2) * 10_000
    return wide.join(later, [*by, "exit_ts"]).withColumns(
        {
            "long_return": change("exit_bid", ask),
            "short_return": F.try_divide(F.col(bid), F.col("exit_ask")) - 1,
            "entry_spread_bps": bps(bid, ask),
            "exit_spread_bps": bps("exit_bid", "exit_ask"),
        }
    )


def hedged(events: DataFrame, prices: DataFrame, by: list[str], delay: int, hold: int, weight: float, cost: float, hedge: DataFrame | None = None, ts: str = "ts", close: str = "close") -> DataFrame:
    """Short the entity, long ``weight`` of the hedge from ts + delay to ts + delay + hold, less cost.

    ``prices`` has (by, ts, close). ``hedge`` has (ts, hedge_close), one row per time; without it the hedge return is 0.
    Four equi-joins on exact times; events without a price at either end are left out.
    """
    at = events.withColumns({"entry_ts": shift(ts, delay), "exit_ts": shift(ts, delay + hold)})
    for end in ("entry", "exit"):
        own = prices.select(*by, F.col(ts).alias(f"{end}_ts"), F.col(close).alias(f"{end}_price"))
        at = at.join(own, [*by, f"{end}_ts"])
        if hedge is not None:
            at = at.join(hedge.select(F.col(ts).alias(f"{end}_ts"), F.col("hedge_close").alias(f"hedge_{end}")), f"{end}_ts")
    moved = change("hedge_exit", "hedge_entry") if hedge is not None else F.lit(0.0)
    gross = -change("exit_price", "entry_price") + F.lit(weight) * moved
    return at.withColumns({"hedge_return": moved, "gross": gross}).withColumn("net", F.col("gross") - cost)


def excursions(trades: DataFrame, prices: DataFrame, by: list[str], step: int, tie: str = "id", ts: str = "ts", close: str = "close") -> DataFrame:
    """Worst and best return of a short on its path of steps from entry to exit inclusive; null unless every point is there.

    The expected points are listed and joined by equality, so no range join is made.
    """
    points = F.sequence(F.lit(0).cast("long"), F.floor(seconds_between("entry_ts", "exit_ts") / step))
    listed = trades.select(tie, *by, "entry_price", F.size(points).alias("expected"), F.explode(F.transform(points, lambda i: shift("entry_ts", i * step))).alias("_at"))
    path = listed.join(prices.select(*by, F.col(ts).alias("_at"), F.col(close).alias("_p")), [*by, "_at"], "left")
    r = -change("_p", "entry_price")
    out = path.groupBy(tie).agg(F.min(r).alias("_mae"), F.max(r).alias("_mfe"), F.count("_p").alias("points"), F.first("expected").alias("expected"))
    whole = F.col("points") == F.col("expected")
    return out.select(tie, "points", "expected", F.when(whole, F.col("_mae")).alias("mae"), F.when(whole, F.col("_mfe")).alias("mfe"))


def band_sum(events: DataFrame, payments: DataFrame, by: list[str], value: str, tie: str = "id", start: str = "entry_ts", end: str = "exit_ts", ts: str = "ts") -> DataFrame:
    """Every event with the sum of its key's payments in (start, end].

    Running totals looked up at both ends: one sorted pass over payments and ends, not a join of pairs.
    """
    totals = payments.select(*by, F.col(ts).alias("_t"), F.lit(0).alias("_s"), F.col(value).alias("_v"))
    for name, c in (("start", start), ("end", end)):
        totals = totals.unionByName(events.select(*by, F.col(c).alias("_t"), F.lit(1).alias("_s"), F.col(tie).alias("_id"), F.lit(name).alias("_which")), allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy("_t", "_s").rowsBetween(Window.unboundedPreceding, 0)
    run = totals.withColumn("_c", F.sum(F.coalesce("_v", F.lit(0.0))).over(w)).where(F.col("_id").isNotNull())
    sums = run.groupBy(F.col("_id").alias(tie)).agg((F.max(F.when(F.col("_which") == "end", F.col("_c"))) - F.max(F.when(F.col("_which") == "start", F.col("_c")))).alias("paid"))
    return events.join(sums, tie, "left")


NOTIONALS = (25.0, 50.0, 100.0, 250.0, 500.0)


def sweep(levels: DataFrame, key: list[str], notionals: tuple[float, ...], order: Column, tie: str, price: str = "price", amount: str = "amount") -> DataFrame:
    """Buying each notional through ask levels in order: notional, depth_ok, quantity, average price, unfilled part; null prices
    unless filled. One sorted pass over the levels serves all notionals."""
    w = Window.partitionBy(*key).orderBy(order, tie)
    value = F.col(price) * F.col(amount)
    before = F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    placed = levels.withColumns({"_v": value, "_b": before})
    spent = lambda n: F.greatest(F.lit(0.0), F.least(F.col("_v"), F.lit(float(n)) - F.col("_b")))
    sums = placed.groupBy(*key).agg(*(x for i, n in enumerate(notionals) for x in (F.sum(spent(n)).alias(f"_f{i}"), F.sum(spent(n) / F.col(price)).alias(f"_q{i}"))))
    grid = F.array(*(F.struct(F.lit(float(n)).alias("notional"), F.col(f"_f{i}").alias("filled"), F.col(f"_q{i}").alias("q")) for i, n in enumerate(notionals)))
    out = sums.select(*key, F.explode(grid).alias("_x")).select(*key, "_x.*")
    left = F.col("notional") - F.col("filled")
    done = left <= 1e-9
    return out.select(*key, "notional", done.alias("depth_ok"), F.greatest(left, F.lit(0.0)).alias("unfilled"), F.when(done, F.col("q")).alias("quantity"), F.when(done, F.try_divide("filled", "q")).alias("vwap"))


def sell_sweep(levels: DataFrame, key: list[str], quantity: str, order: Column, tie: str, price: str = "price", amount: str = "amount") -> DataFrame:
    """Selling each key's ``quantity`` through bid levels in order: proceeds, null unless all of it is sold."""
    w = Window.partitionBy(*key).orderBy(order, tie)
    before = F.coalesce(F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    sold = F.greatest(F.lit(0.0), F.least(F.col(amount), F.col(quantity) - before))
    out = levels.withColumn("_x", sold).groupBy(*key, quantity).agg(F.sum("_x").alias("sold"), F.sum(F.col("_x") * F.col(price)).alias("_p"))
    return out.select(*key, "sold", F.when(F.col(quantity) - F.col("sold") <= 1e-9, F.col("_p")).alias("proceeds"))


def capacity_returns(entries: DataFrame, bids: DataFrame, key: list[str], order: Column, tie: str, price: str = "price", amount: str = "amount") -> DataFrame:
    """The return of each of ``sweep``'s notionals when what it bought is sold through the bids: key, notional, depth_ok,
    proceeds, vwap, return. depth_ok is false and the rest null where either side lacks depth or the key has no bids."""
    w = Window.partitionBy(*key).orderBy(order, tie)
    before = F.coalesce(F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    placed = bids.select(*key, F.col(price).alias("_p"), F.col(amount).alias("_a"), before.alias("_b"))
    met = entries.select(*key, "notional", "quantity").join(placed, key, "left")
    sold = F.greatest(F.lit(0.0), F.least(F.col("_a"), F.col("quantity") - F.col("_b")))
    out = met.withColumn("_s", sold).groupBy(*key, "notional", "quantity").agg(F.sum("_s").alias("_sold"), F.sum(F.col("_s") * F.col("_p")).alias("_x"))
    done = F.coalesce((F.col("quantity") - F.col("_sold") <= 1e-9) & (F.col("_sold") > 0), F.lit(False))
    return out.select(*key, "notional", done.alias("depth_ok"), F.when(done, F.col("_x")).alias("proceeds"), F.when(done, F.col("_x") / F.col("_sold")).alias("vwap"), F.when(done, F.col("_x") / F.col("notional") - 1).alias("return"))


def passive_fill(orders: DataFrame, bars: DataFrame, by: list[str], minutes: int, step: int = 60, tie: str = "id", ts: str = "ts", limit: str = "limit", low: str = "low") -> DataFrame:
    """First of the next ``minutes`` bars whose low reaches the limit, by equality on the listed bar times."""
    listed = orders.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(minutes - 1)))).withColumn("_at", shift(ts, F.col("_k") * step))
    hit = listed.join(bars.select(*by, F.col(ts).alias("_at"), F.col(low).alias("_low")), [*by, "_at"]).where(F.col("_low") <= F.col(limit))
    return orders.join(hit.groupBy(tie).agg(F.min("_at").alias("fill_ts")), tie, "left")
