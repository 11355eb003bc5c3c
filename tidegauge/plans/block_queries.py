"""Queries of the feature blocks and level parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions import blocks as K
from tidegauge.plans.inputs import HOURLY, hourly, read, rounded
from tidegauge.plans.registry import query

MINUTES = f"""{HOURLY}, m as (select venue, bucket as minute, n as trades, n - n // 2 as buys, n // 2 as sells, volume * 0.6 as buy_volume, volume * 0.4 as sell_volume, vwap, open as first_price, close as last_price, high, low, n as quotes,
  (high - low) / close * 100 as avg_spread_bps, (close + low) / 2 as last_mid, (high + low) / 2 as avg_mid from bars)"""


@query(
    "F5_microstructure_block",
    f"""with {MINUTES} select venue, minute, minute + interval 1 hour as decision_ts, round(avg_spread_bps, 6) as avg_spread_bps, round((buy_volume - sell_volume) / nullif(buy_volume + sell_volume, 0), 6) as trade_imbalance, round(buys / trades, 6) as buy_trade_share,
  round((vwap / nullif(avg_mid, 0) - 1) * 10000, 4) as vwap_mid_bps, round(last_price / nullif(first_price, 0) - 1, 6) as minute_return, round((high / nullif(low, 0) - 1) * 10000, 4) as range_bps, round(ln(1 + greatest(buy_volume + sell_volume, 0)), 6) as log_volume,
  case when lag(minute, 1) over w = minute - interval 1 hour then round(last_mid / nullif(lag(last_mid, 1) over w, 0) - 1, 6) end as mid_return_1, case when lag(minute, 5) over w = minute - interval 5 hours then round(last_mid / nullif(lag(last_mid, 5) over w, 0) - 1, 6) end as mid_return_5,
  case when lag(minute, 4) over w = minute - interval 4 hours and count(avg_spread_bps) over w5 = 5 then round(avg(avg_spread_bps) over w5, 6) end as spread_5 from m window w as (partition by venue order by minute), w5 as (partition by venue order by minute rows 4 preceding)""",
)
def microstructure_block(spark, sf_dir):
    h = hourly(spark, sf_dir)
    half = F.floor(F.col("n") / 2)
    m = h.select(
        "venue", F.col("bucket").alias("minute"), F.col("n").alias("trades"), (F.col("n") - half).alias("buys"), F.lit(0).alias("unknown"), (F.col("volume") * 0.6).alias("buy_volume"), (F.col("volume") * 0.4).alias("sell_volume"), "vwap",
        F.col("open").alias("first_price"), F.col("close").alias("last_price"), "high", "low", F.col("n").alias("quotes"), ((F.col("high") - F.col("low")) / F.col("close") * 100).alias("avg_spread_bps"), ((F.col("close") + F.col("low")) / 2).alias("last_mid"),
        ((F.col("high") + F.col("low")) / 2).alias("avg_mid"), F.lit(0.0).alias("min_spread_bps"), F.lit(1.0).alias("max_spread_bps"), F.lit(1.0).alias("last_spread_bps"), F.lit(1.0).alias("last_bid_size"), F.lit(2.0).alias("last_ask_size"),
        F.lit(1.0).alias("avg_bid_size"), F.lit(2.0).alias("avg_ask_size"),
    )
    out = K.microstructure(m, ["venue"], step=3600)
    kept = ["avg_spread_bps", "trade_imbalance", "buy_trade_share", "minute_return", "log_volume", "mid_return_1", "mid_return_5", "spread_5"]
    return rounded(rounded(out.select("venue", "minute", "decision_ts", *kept, "vwap_mid_bps", "range_bps"), 6, *kept), 4, "vwap_mid_bps", "range_bps")


@query(
    "F6_derivative_block",
    f"""with {HOURLY}, d as (select *, vwap as mark, case when lag(bucket) over (partition by venue order by bucket) = bucket - interval 1 hour then vwap / nullif(lag(vwap) over (partition by venue order by bucket), 0) - 1 end as mret,
  case when lag(bucket) over (partition by venue order by bucket) = bucket - interval 1 hour then close / nullif(lag(close) over (partition by venue order by bucket), 0) - 1 end as ret, (vwap / nullif(close, 0) - 1) * 10000 as basis from bars)
select venue, bucket, round(basis, 6) + 0.0 as basis_bps, round(abs(basis), 6) as abs_basis_bps, case when lag(bucket) over w = bucket - interval 1 hour then round(basis - lag(basis) over w, 6) + 0.0 end as basis_change_1, round(mret, 6) + 0.0 as mark_return, round(mret - ret, 6) + 0.0 as divergence,
  round(volume / 1000 * 10000 / 1000, 6) as funding_bps, round(date_diff('second', first_ts, bucket) / 3600, 6) as funding_age_hours,
  case when lag(bucket, 4) over w = bucket - interval 4 hours then round(close / nullif(lag(close, 4) over w, 0) - 1, 6) end as return_4, round((high / nullif(low, 0) - 1) * 10000, 4) as range_bps,
  case when count(basis) over w96 = 96 and stddev_samp(basis) over w96 > 0 then round((basis - avg(basis) over w96) / stddev_samp(basis) over w96, 6) end as basis_z96 from d window w as (partition by venue order by bucket), w96 as (partition by venue order by bucket rows 95 preceding)""",
)
def derivative_block(spark, sf_dir):
    h = hourly(spark, sf_dir)
    b = h.select(
        "venue", "bucket", "open", "high", "low", "close", "volume", "quote_volume", F.col("n").alias("trades"), F.lit(0.5).alias("taker_share"), F.lit(0.0).alias("final_return"), "close_vs_vwap", "high_to_close", F.col("vwap").alias("mark"),
        F.col("high").alias("mark_high"), F.col("low").alias("mark_low"), (F.col("volume") / 1_000_000).alias("rate"), F.date_trunc("second", "first_ts").cast("timestamp_ntz").alias("funding_ts"),
    )
    out = K.derivative(b, ["venue"], step=3600)
    kept = ["basis_bps", "abs_basis_bps", "basis_change_1", "mark_return", "divergence", "funding_bps", "funding_age_hours", "return_4", "basis_z96"]
    return rounded(rounded(out.select("venue", "bucket", *kept, "range_bps"), 6, *kept), 4, "range_bps")


@query("F19_price_levels", "select l_orderkey, count(*) filter (l_discount > 0) as levels, round(sum(l_discount) filter (l_discount > 0), 6) as total from lineitem group by 1")
def price_levels(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem")
    pair = F.array(F.col("l_discount"), F.lit(1.0))
    as_object = F.struct(F.col("l_discount").alias("price"), F.lit(1.0).alias("size"))
    text = items.groupBy("l_orderkey").agg(F.when(F.col("l_orderkey") % 2 == 0, F.to_json(F.collect_list(pair))).otherwise(F.to_json(F.collect_list(as_object))).alias("t"))
    levels = text.select("l_orderkey", K.price_levels("t").alias("l"))
    total = F.aggregate("l", F.lit(0.0), lambda s, x: s + x["price"])
    return levels.select("l_orderkey", F.size("l").cast("long").alias("levels"), F.when(F.size("l") > 0, F.round(total, 6)).alias("total"))


