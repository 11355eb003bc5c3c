"""Feature blocks of minute facts and of spot and derivative bars, and price-level parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalars import change, imbalance, log1p_clipped, ratio
from tidegauge.functions.time import col, seconds_between, shift
from tidegauge.operators.features import full_window, guarded, last_rows, series, zscore


def microstructure(minutes: DataFrame, by: list[str], ts: str = "minute", step: int = 60) -> DataFrame:
    """22 features of each minute of facts (trades, buys, unknown, buy_volume, sell_volume, vwap, first_price,
    last_price, high, low, quotes, avg/min/max/last spread in bps, avg_mid, last_mid, bid/ask sizes average and last),
    known at the minute's end. Values over several minutes are null across gaps."""
    w = series(by, ts)
    bps = lambda a, b: change(a, b) * 10_000
    quote_now, quote_avg = imbalance("last_bid_size", "last_ask_size"), imbalance("avg_bid_size", "avg_ask_size")
    base = minutes.withColumns({"_flow": imbalance("buy_volume", "sell_volume"), "_quote": quote_avg})
    five = lambda c: guarded(full_window(F.avg(c).over(last_rows(w, 5)), c, w, 5), w, ts, 4, step)
    volume = F.col("buy_volume") + F.col("sell_volume")
    features = {
        "avg_spread_bps": F.col("avg_spread_bps"),
        "last_spread_bps": F.col("last_spread_bps"),
        "spread_range_bps": F.col("max_spread_bps") - F.col("min_spread_bps"),
        "trade_imbalance": F.col("_flow"),
        "buy_trade_share": ratio("buys", "trades"),
        "unknown_share": ratio("unknown", "trades"),
        "last_quote_imbalance": quote_now,
        "avg_quote_imbalance": F.col("_quote"),
        "vwap_mid_bps": bps("vwap", "avg_mid"),
        "last_mid_bps": bps("last_price", "last_mid"),
        "minute_return": change("last_price", "first_price"),
        "range_bps": bps("high", "low"),
        "log_notional": log1p_clipped(F.col("vwap") * volume),
        "log_volume": log1p_clipped(volume),
        "log_trades": log1p_clipped("trades"),
        "log_quotes": log1p_clipped("quotes"),
        "mid_return_1": guarded(change("last_mid", F.lag("last_mid", 1).over(w)), w, ts, 1, step),
        "mid_return_5": guarded(change("last_mid", F.lag("last_mid", 5).over(w)), w, ts, 5, step),
        "spread_change": guarded(F.col("avg_spread_bps") - F.lag("avg_spread_bps", 1).over(w), w, ts, 1, step),
        "imbalance_5": five("_flow"),
        "spread_5": five("avg_spread_bps"),
        "quote_imbalance_5": five("_quote"),
    }
    return base.select(*by, ts, shift(ts, step).alias("decision_ts"), *(c.alias(k) for k, c in features.items()))


def derivative(bars: DataFrame, by: list[str], ts: str = "bucket", step: int = 900) -> DataFrame:
    """27 features of spot bars (open, high, low, close, volume, quote_volume, trades, taker_share, final_return,
    close_vs_vwap, high_to_close) beside mark prices (mark, mark_high, mark_low) and funding (rate, funding_ts)."""
    w = series(by, ts)
    b = bars.withColumns({"_basis": change("mark", "close") * 10_000, "_mark_ret": guarded(change("mark", F.lag("mark").over(w)), w, ts, 1, step), "_ret": guarded(change("close", F.lag("close").over(w)), w, ts, 1, step)})
    lagged = lambda c, k: guarded(F.col(c) - F.lag(c, k).over(w), w, ts, k, step)
    returns = lambda k: guarded(change("close", F.lag("close", k).over(w)), w, ts, k, step)
    diverged = F.col("_mark_ret") - F.col("_ret")
    features = {
        "basis_bps": F.col("_basis"),
        "abs_basis_bps": F.abs("_basis"),
        "basis_change_1": lagged("_basis", 1),
        "basis_change_4": lagged("_basis", 4),
        "basis_z96": zscore("_basis", w, 96),
        "basis_z672": zscore("_basis", w, 672),
        "mark_return": F.col("_mark_ret"),
        "divergence": diverged,
        "abs_divergence": F.abs(diverged),
        "mark_range_bps": change("mark_high", "mark_low") * 10_000,
        "mark_vs_low": change("mark", "mark_low"),
        "funding_bps": F.col("rate") * 10_000,
        "abs_funding_bps": F.abs(F.col("rate")) * 10_000,
        "funding_change": (F.col("rate") - F.lag("rate").over(w)) * 10_000,
        "funding_age_hours": seconds_between("funding_ts", ts) / 3600,
        "return_1": returns(1),
        "return_4": returns(4),
        "return_16": returns(16),
        "final_bps": F.col("final_return") * 10_000,
        "close_vs_vwap_bps": F.col("close_vs_vwap") * 10_000,
        "rejection_bps": F.col("high_to_close") * 10_000,
        "range_bps": change("high", "low") * 10_000,
        "taker_share": F.col("taker_share"),
        "taker_imbalance": 2 * F.col("taker_share") - 1,
        "log_quote_volume": log1p_clipped("quote_volume"),
        "log_trades": log1p_clipped("trades"),
        "volume_z96": zscore("quote_volume", w, 96),
    }
    return b.select(*by, ts, *(c.alias(k) for k, c in features.items()))


def price_levels(text: Column | str) -> Column:
    """Levels (price, amount) of a JSON list of pairs or of objects with price and size, numbers or strings; those not
    above 0 go."""
    raw = col(text)
    level = lambda p, a: F.struct(p.try_cast("double").alias("price"), a.try_cast("double").alias("amount"))
    pairs = F.transform(F.from_json(raw, "array<array<string>>"), lambda x: level(F.get(x, F.lit(0)), F.get(x, F.lit(1))))
    objects = F.transform(F.from_json(raw, "array<struct<price: string, size: string>>"), lambda x: level(x["price"], x["size"]))
    levels = F.when(raw.rlike(r"^\s*\[\s*\{"), objects).otherwise(pairs)
    return F.filter(levels, lambda x: (x["price"] > 0) & (x["amount"] > 0))
