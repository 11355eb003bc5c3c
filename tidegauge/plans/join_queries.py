"""Queries of joins, aggregations, cross-sections, rankings and limits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.functions import scalars as S
from tidegauge.functions import time as T
from tidegauge.operators import asof as J
from tidegauge.operators import bars as B
from tidegauge.operators import events as E
from tidegauge.operators import features as W
from tidegauge.operators import metrics as M
from tidegauge.operators import outcomes as X
from tidegauge.operators import quantiles as Q
from tidegauge.operators import xsection as C
from tidegauge.operators.scratch import materialize
from tidegauge.plans.inputs import HOURLY, TICKS, bars_sql, hourly, read, rounded, ticks
from tidegauge.plans.registry import query

CLICKS = "clicks as (select * from ticks where venue = 'click'), buys as (select * from ticks where venue = 'purchase')"


def clicks_and_buys(spark, sf_dir):
    t = ticks(spark, sf_dir)
    return t.where("venue = 'click'"), t.where("venue = 'purchase'")


@query(
    "J1_asof_backward",
    f"""with {TICKS}, {CLICKS}, j as (select b.id, c.id as cid, c.price, date_diff('microsecond', c.ts, b.ts) / 1e6 as age from buys b asof left join clicks c on b.entity = c.entity and b.ts >= c.ts)
select id, case when age <= 86400 then cid end as q_id, case when age <= 86400 then price end as q_price, case when age <= 86400 then round(age, 6) end as q_age from j""",
)
def asof_backward(spark, sf_dir):
    clicks, buys = clicks_and_buys(spark, sf_dir)
    out = J.asof_backward(buys.select("entity", "ts", "id"), clicks, ["entity"], ["id", "price"], tolerance=86_400)
    return rounded(out.select("id", "q_id", "q_price", "q_age"), 6, "q_age")


@query(
    "J2_asof_forward",
    f"""with {TICKS}, {CLICKS}, j as (select b.id, c.id as cid, c.price, date_diff('microsecond', b.ts, c.ts) / 1e6 as wait from buys b asof left join clicks c on b.entity = c.entity and b.ts <= c.ts)
select id, cid as q_id, price as q_price, round(wait, 6) as q_wait from j""",
)
def asof_forward(spark, sf_dir):
    clicks, buys = clicks_and_buys(spark, sf_dir)
    out = J.asof_forward(buys.select("entity", "ts", "id"), clicks, ["entity"], ["id", "price"])
    return rounded(out.select("id", "q_id", "q_price", "q_wait"), 6, "q_wait")


@query(
    "J3_asof_book",
    f"""with {TICKS}, {CLICKS}, snaps as (select entity, ts, id, [price, price * 2, price * 3] as levels from clicks)
select b.id, s.levels[1] as first_level, s.levels[3] as last_level, len(s.levels) as depth from buys b asof left join snaps s on b.entity = s.entity and b.ts <= s.ts""",
)
def asof_book(spark, sf_dir):
    clicks, buys = clicks_and_buys(spark, sf_dir)
    snaps = clicks.select("entity", "ts", "id", F.array("price", F.col("price") * 2, F.col("price") * 3).alias("levels"))
    out = J.asof_forward(buys.select("entity", "ts", "id"), snaps, ["entity"], ["levels"])
    levels = F.col("q_levels")
    return out.select("id", F.get(levels, F.lit(0)).alias("first_level"), F.get(levels, F.lit(2)).alias("last_level"), F.when(levels.isNotNull(), F.size(levels)).cast("long").alias("depth"))


@query(
    "J4_state_in_force",
    """with s as (select o_custkey, o_orderdate, o_orderkey, o_orderstatus, lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as to_ts from orders)
select o_orderkey, o_orderdate as from_ts, to_ts, o_orderstatus from s""",
)
def state_in_force(spark, sf_dir):
    out = J.in_force(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey")
    return out.select("o_orderkey", "from_ts", "to_ts", "o_orderstatus")


@query(
    "J5_exact_lag",
    f"with {HOURLY} select b.venue, b.bucket, b.close, p.close as close_before, coalesce(p.close > 50, false) as was_high from bars b left join bars p on b.venue = p.venue and p.bucket = b.bucket - interval 3 hours",
)
def exact_lag(spark, sf_dir):
    out = W.exact_lag(hourly(spark, sf_dir).select("venue", "bucket", "close"), ["venue"], "bucket", 3 * 3600, ["close"], "_before")
    return out.select("venue", "bucket", "close", "close_before", F.coalesce(F.col("close_before") > 50, F.lit(False)).alias("was_high"))


HEDGE = "h as (select bucket, avg(close) as hedge_close from bars group by 1)"


@query(
    "J6_four_prices",
    f"""with {HOURLY}, {HEDGE} select e.venue, e.bucket, a.close as entry_price, x.close as exit_price, round(ha.hedge_close, 9) as hedge_entry, round(hx.hedge_close, 9) as hedge_exit from bars e
  join bars a on a.venue = e.venue and a.bucket = e.bucket + interval 2 hours join bars x on x.venue = e.venue and x.bucket = e.bucket + interval 10 hours
  join h ha on ha.bucket = a.bucket join h hx on hx.bucket = x.bucket""",
)
def four_prices(spark, sf_dir):
    bars = hourly(spark, sf_dir).select("venue", F.col("bucket").alias("ts"), "close")
    hedge = bars.groupBy("ts").agg(F.avg("close").alias("hedge_close"))
    out = X.hedged(bars.select("venue", "ts"), bars, ["venue"], 7200, 8 * 3600, 0.75, 0.0, hedge)
    return rounded(out.select("venue", F.col("ts").alias("bucket"), "entry_price", "exit_price", "hedge_entry", "hedge_exit"), 9, "hedge_entry", "hedge_exit")


@query(
    "J7_exact_horizons",
    f"""with {HOURLY} select e.venue, e.bucket, cast(h as int) as horizon, e.close as entry_value, x.close as exit_value, round(x.close / nullif(e.close, 0) - 1, 6) as gross
  from bars e, unnest([3600, 14400, 86400]) as t(h), bars x where x.venue = e.venue and x.bucket = e.bucket + to_seconds(h)""",
)
def exact_horizons(spark, sf_dir):
    out = X.forward_outcomes(hourly(spark, sf_dir), ["venue"], "bucket", [3600, 14_400, 86_400], "close", "close")
    return rounded(out.select("venue", "bucket", "horizon", "entry_value", "exit_value", "gross"), 6, "gross")


@query(
    "J8_same_time_cross_asset",
    f"""with {HOURLY}, r as (select venue, bucket, close / nullif(open, 0) - 1 as ret from bars) select s.venue as source, t.venue as target, s.bucket, round(s.ret, 6) as source_ret, round(t.ret, 6) as target_ret from r s join r t on s.bucket = t.bucket and s.venue <> t.venue""",
)
def cross_asset(spark, sf_dir):
    r = hourly(spark, sf_dir).select("venue", "bucket", S.change("close", "open").alias("ret"))
    s, t = r.select(F.col("venue").alias("source"), "bucket", F.round("ret", 6).alias("source_ret")), r.select(F.col("venue").alias("target"), "bucket", F.round("ret", 6).alias("target_ret"))
    return s.join(t, "bucket").where("source <> target")


@query(
    "J9_band_sum",
    f"""with {TICKS}, {CLICKS} select b.id, round(coalesce(sum(c.price), 0), 4) as paid from buys b left join clicks c on c.entity = b.entity and c.ts > b.ts and c.ts <= b.ts + interval 2 days group by b.id""",
)
def band_sum(spark, sf_dir):
    clicks, buys = clicks_and_buys(spark, sf_dir)
    events = buys.select("id", "entity", F.col("ts").alias("entry_ts"), T.shift("ts", 2 * 86_400).alias("exit_ts"))
    return X.band_sum(events, clicks, ["entity"], "price").select("id", F.round("paid", 4).alias("paid"))


@query(
    "J10_paths",
    f"""with {HOURLY}, e as (select venue || '/' || strftime(bucket, '%Y-%m-%d %H:%M:%S') as id, venue, bucket, close from bars where hour(bucket) = 0),
p as (select e.id, e.close as c0, unnest(range(5)) as k, e.venue, e.bucket from e)
select p.id, count(b.close) as points, case when count(b.close) = 5 then round(min(1 - b.close / c0), 6) end as mae, case when count(b.close) = 5 then round(max(1 - b.close / c0), 6) end as mfe
  from p left join bars b on b.venue = p.venue and b.bucket = p.bucket + to_hours(p.k) group by p.id""",
)
def paths(spark, sf_dir):
    bars = hourly(spark, sf_dir).select("venue", F.col("bucket").alias("ts"), "close")
    e = bars.where(F.hour("ts") == 0).withColumn("id", F.concat_ws("/", "venue", F.col("ts").cast("string")))
    trades = e.select("id", "venue", F.col("close").alias("entry_price"), F.col("ts").alias("entry_ts"), T.shift("ts", 4 * 3600).alias("exit_ts"))
    return rounded(X.excursions(trades, bars, ["venue"], 3600).select("id", "points", "mae", "mfe"), 6, "mae", "mfe")


@query(
    "J11_peer_baskets",
    f"""with {HOURLY}, r as (select venue, bucket, close / nullif(open, 0) - 1 as ret from bars) select a.venue, a.bucket, round(avg(b.ret), 6) as peers from r a left join r b on b.bucket = a.bucket and b.venue <> a.venue group by all""",
)
def peer_baskets(spark, sf_dir):
    r = hourly(spark, sf_dir).select("venue", "bucket", S.change("close", "open").alias("ret"))
    return rounded(C.leave_one_out_mean(r, ["bucket"], "ret").select("venue", "bucket", "peers"), 6, "peers")


@query("J12_anti_join", "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')")
def anti_join(spark, sf_dir):
    waiting = read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey").join(waiting, "c_custkey", "left_anti")


@query("J13_semi_join", "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderdate >= timestamp '2001-06-01')")
def semi_join(spark, sf_dir):
    recent = read(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz")).select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey").join(recent, "c_custkey", "left_semi")


WINDOWS = "w as (select entity, id as wid, ts as trigger_ts, ts - interval 3 hours as start, ts + interval 3 hours as \"end\" from ticks where venue = 'error')"


def error_windows(t):
    return t.where("venue = 'error'").select("entity", F.col("id").alias("wid"), F.col("ts").alias("trigger_ts"), T.shift("ts", -3 * 3600).alias("start"), T.shift("ts", 3 * 3600).alias("end"))


@query(
    "J15_latest_window",
    f"""with {TICKS}, {CLICKS}, {WINDOWS} select b.id, arg_max(w.wid, w.trigger_ts) as window_id, count(w.wid) as windows from buys b left join w on w.entity = b.entity and b.ts between w.start and w."end" group by b.id""",
)
def latest_window(spark, sf_dir):
    t = ticks(spark, sf_dir)
    buys = t.where("venue = 'purchase'").select("id", "entity", "ts")
    found = J.interval_join(buys, error_windows(t), ["entity"], 6 * 3600)
    best = found.groupBy("id").agg(F.max_by("wid", F.struct("trigger_ts", "wid")).alias("window_id"), F.count("*").alias("windows"))
    return buys.select("id").join(best, "id", "left").withColumn("windows", F.coalesce("windows", F.lit(0)))


@query(
    "J16_overlap_check",
    f"""with {TICKS} select a.entity, count(*) as overlapped from ticks a where exists (select 1 from ticks b where b.entity = a.entity and b.ts < a.ts and b.ts + interval 2 hours > a.ts) group by 1""",
)
def overlap_check(spark, sf_dir):
    w = Window.partitionBy("entity").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, -1)
    t = ticks(spark, sf_dir).withColumn("_end", T.shift("ts", 7200))
    return t.withColumn("_reach", F.max("_end").over(w)).where("_reach > ts").groupBy("entity").agg(F.count("*").alias("overlapped"))


@query(
    "J17_null_safe_join",
    """with a as (select l_orderkey, l_linenumber, case when l_tax > 0 then l_tax end as t from lineitem), b as (select case when k > 0 then k / 100.0 end as t, k from (select unnest(range(9)) as k))
select l_orderkey, l_linenumber, k from a join b on a.t is not distinct from cast(b.t as double)""",
)
def null_safe_join(spark, sf_dir):
    a = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("t"))
    b = spark.range(9).select(F.when(F.col("id") > 0, F.col("id") / 100.0).alias("t"), F.col("id").alias("k"))
    return J.null_safe_join(a, F.broadcast(b), ["t"]).select("l_orderkey", "l_linenumber", "k")


@query(
    "J18_membership_at",
    f"""with {TICKS}, u as (select distinct entity, case when entity % 2 = 0 then timestamp '2024-01-01' else timestamp '2024-01-10' end as valid_from, case when entity % 3 = 0 then timestamp '2024-01-20' else timestamp '2024-02-01' end as valid_to from ticks)
select t.id from ticks t join u on u.entity = t.entity and t.ts >= valid_from and t.ts < valid_to""",
)
def membership_at(spark, sf_dir):
    t = ticks(spark, sf_dir)
    when = lambda c, a, b: F.when(c, a).otherwise(b).cast("timestamp_ntz")
    u = t.select("entity").distinct().select("entity", when(F.col("entity") % 2 == 0, "2024-01-01 00:00:00", "2024-01-10 00:00:00").alias("valid_from"), when(F.col("entity") % 3 == 0, "2024-01-20 00:00:00", "2024-02-01 00:00:00").alias("valid_to"))
    return t.join(u, "entity").where("ts >= valid_from and ts < valid_to").select("id")


@query(
    "J19_month_lookup",
    """with m as (select o_custkey, cast(date_trunc('month', o_orderdate) as date) as month, max(o_totalprice) as top from orders where o_orderstatus = 'F' group by all)
select o_orderkey, top from orders left join m on m.o_custkey = orders.o_custkey and m.month = cast(date_trunc('month', o_orderdate) as date)""",
)
def month_lookup(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    monthly = o.where("o_orderstatus = 'F'").groupBy("o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(F.max("o_totalprice").alias("top"))
    return J.month_lookup(o, monthly, ["o_custkey"], "o_orderdate").select("o_orderkey", "top")


@query(
    "J20_parameter_cross",
    "select p_partkey, q, side, round(p_retailprice * q * side, 4) as scaled from part, unnest([0.02::double, 0.05::double, 0.1::double]) as a(q), unnest([1, -1]) as b(side)",
)
def parameter_cross(spark, sf_dir):
    grid = F.broadcast(spark.createDataFrame([(q, s) for q in (0.02, 0.05, 0.1) for s in (1, -1)], "q double, side int"))  # six rows
    return read(spark, sf_dir, "part").crossJoin(grid).select("p_partkey", "q", "side", F.round(F.col("p_retailprice") * F.col("q") * F.col("side"), 4).alias("scaled"))


@query(
    "J21_retention_window",
    f"""with {TICKS} select d.id as detection, count(o.id) as rows, round(sum(o.price), 4) as total from ticks d join ticks o on o.entity = d.entity and o.ts >= d.ts - interval 2 hours and o.ts <= d.ts where d.venue = 'error' group by 1""",
)
def retention_window(spark, sf_dir):
    t = ticks(spark, sf_dir)
    d = t.where("venue = 'error'").select("entity", F.col("id").alias("detection"), T.shift("ts", -7200).alias("start"), F.col("ts").alias("end"))
    found = J.interval_join(t.select("entity", "ts", "price"), d, ["entity"], 7200)
    return found.groupBy("detection").agg(F.count("*").alias("rows"), F.round(F.sum("price"), 4).alias("total"))


# ---- aggregations ----------------------------------------------------------------------------------------------------


@query(
    "A5_market_state",
    f"""with {HOURLY}, r as (select venue, bucket, close / nullif(lag(close) over (partition by venue order by bucket), 0) - 1 as ret from bars)
select bucket, count(*) as n, round(avg((ret > 0)::int), 6) as breadth, round(avg(ret), 6) as mean, round(median(ret), 6) as median, round(stddev_samp(ret), 6) as dispersion, round(quantile_cont(ret, 0.1), 6) as p10,
  round(quantile_cont(ret, 0.9), 6) as p90, round(max(case when venue = 'view' then ret end), 6) as view from r where ret is not null group by 1""",
)
def market_state(spark, sf_dir):
    r = hourly(spark, sf_dir).withColumn("ret", S.change("close", F.lag("close").over(W.series(["venue"]))))
    return rounded(C.market_state(r, "bucket", "ret", {"view": "view"}, "venue"), 6, "breadth", "mean", "median", "dispersion", "p10", "p90", "view")


NET = """t as (select p_brand as brand, p_type as kind, ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey as id, l_shipdate as ts, l_suppkey as supplier, round(l_discount - 0.05 + l_tax / 10, 4) as net,
  round(-l_tax / 2, 4) as mae, round(l_discount / 2, 4) as mfe, l_linenumber as concurrency from lineitem join part on p_partkey = l_partkey)"""
#: The order of trades: lines that agree in all of these agree in all that a metric reads.
ORDER = "ts, id, net"


def trades(spark, sf_dir):
    """Line items as trades: discount and tax as a signed return. Several lines may share an id."""
    items = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return items.select(
        F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), (((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100_000 + F.col("l_partkey")) * 10_000 + F.col("l_suppkey")).alias("id"), F.col("l_shipdate").alias("ts"), F.col("l_suppkey").alias("supplier"),
        F.round(F.col("l_discount") - 0.05 + F.col("l_tax") / 10, 4).alias("net"), F.round(-F.col("l_tax") / 2, 4).alias("mae"), F.round(F.col("l_discount") / 2, 4).alias("mfe"), F.col("l_linenumber").alias("concurrency"),
    )


EVENT_SQL = """count(net) as n, round(avg(net), 6) as mean, round(median(net), 6) as median, round(avg((net > 0)::int), 6) as hit_rate, round(coalesce(sum(net) filter (net > 0), 0) / -sum(net) filter (net < 0), 6) as profit_factor, min(net) as worst,
  round(avg(net) filter (net > 0), 6) as avg_winner, round(avg(net) filter (net < 0), 6) as avg_loser, round(case when min(net) >= 0 then 0 else -min(net) / avg(net) filter (net > 0) end, 6) as worst_loss_ratio, round(stddev_samp(net), 6) as sd"""


@query("A6_event_metrics", f"with {NET} select brand, {EVENT_SQL} from t group by 1")
def event_metrics(spark, sf_dir):
    out = M.event_metrics(trades(spark, sf_dir), ["brand"])
    return rounded(out, 6, "mean", "median", "hit_rate", "profit_factor", "avg_winner", "avg_loser", "worst_loss_ratio", "sd")


TRADE_ROUNDED = ["hit_rate", "hit_low", "hit_high", "mean", "median", "avg_winner", "median_winner", "avg_loser", "median_loser", "profit_factor", "p05", "p01", "worst_loss_ratio", "losers_near", "total", "drawdown", "avg_concurrency"]


@query(
    "A7_trade_metrics",
    f"""with {NET}, r as (select *, row_number() over w as i, sum(net) over w as s, date_diff('second', lag(ts) over (partition by brand order by {ORDER}), ts) as gap from t window w as (partition by brand order by {ORDER} rows unbounded preceding)),
k as (select *, greatest(0, max(s) over (partition by brand order by i rows unbounded preceding)) as peak from r),
l as (select brand, i - row_number() over (partition by brand order by i) as g from r where net < 0), streaks as (select brand, max(n) as losing_streak from (select brand, g, count(*) as n from l group by all) group by 1),
sym as (select brand, max(n) as most_of_one_symbol from (select brand, supplier, count(*) as n from t group by all) group by 1),
a as (select brand, count(*) as n, count(*) filter (net > 0) as wins, count(*) filter (net < 0) as losses, count(*) filter (net = 0) as flats, count(distinct supplier) as n_symbols, count(distinct cast(ts as date)) as n_dates, avg(net) as mean, median(net) as median,
  avg(net) filter (net > 0) as avg_winner, median(net) filter (net > 0) as median_winner, avg(net) filter (net < 0) as avg_loser, median(net) filter (net < 0) as median_loser, sum(net) filter (net > 0) as gain, -sum(net) filter (net < 0) as loss,
  coalesce(min(net) filter (net < 0), 0) as worst_loss, quantile_cont(net, 0.05) as p05, quantile_cont(net, 0.01) as p01, min(mae) as worst_mae, max(mfe) as best_mfe, sum(net) as total, min(s - peak) as drawdown, max(gap) as longest_gap,
  max(concurrency) as max_concurrency, avg(concurrency) as avg_concurrency, list(net) filter (net < 0) as losers, 1.959963984540054 as z from k group by 1)
select brand, n, wins, losses, flats, n_symbols, n_dates, most_of_one_symbol, round(wins / n, 6) as hit_rate, round((wins / n + z * z / (2 * n) - z * sqrt(wins / n * (1 - wins / n) / n + z * z / (4 * n * n))) / (1 + z * z / n), 6) as hit_low,
  round((wins / n + z * z / (2 * n) + z * sqrt(wins / n * (1 - wins / n) / n + z * z / (4 * n * n))) / (1 + z * z / n), 6) as hit_high, round(mean, 6) as mean, round(median, 6) as median, round(avg_winner, 6) as avg_winner, round(median_winner, 6) as median_winner,
  round(avg_loser, 6) as avg_loser, round(median_loser, 6) as median_loser, round(case when losses > 0 then coalesce(gain, 0) / loss when wins > 0 then 'inf'::double end, 6) as profit_factor, worst_loss, round(p05, 6) as p05, round(p01, 6) as p01, worst_mae, best_mfe,
  round(case when avg_winner > 0 then -worst_loss / avg_winner end, 6) as worst_loss_ratio, round(case when losses > 0 and avg_winner > 0 then len(list_filter(losers, lambda v: -v <= 0.1 * avg_winner)) / losses when losses = 0 then 1 end, 6) as losers_near,
  round(total, 6) as total, round(drawdown, 6) as drawdown, coalesce(losing_streak, 0) as losing_streak, longest_gap, max_concurrency, round(avg_concurrency, 6) as avg_concurrency from a join sym using (brand) left join streaks using (brand)""",
)
def trade_metrics(spark, sf_dir):
    return rounded(M.trade_metrics(trades(spark, sf_dir), ["brand"], symbol="supplier"), 6, *TRADE_ROUNDED)


@query("W9_drawdown", f"""with {NET}, r as (select *, sum(net) over (partition by kind order by {ORDER} rows unbounded preceding) as s from t), k as (select *, greatest(0, max(s) over (partition by kind order by {ORDER} rows unbounded preceding)) as peak from r)
select kind, round(min(s - peak), 6) as drawdown from k group by 1""")
def drawdown(spark, sf_dir):
    return M.path_metrics(trades(spark, sf_dir), ["kind"]).select("kind", F.round("drawdown", 6).alias("drawdown"))


@query("W10_losing_streaks", f"""with {NET}, r as (select *, row_number() over (partition by brand order by {ORDER}) as i from t), l as (select brand, i - row_number() over (partition by brand order by i) as g from r where net < 0),
i as (select brand, g, count(*) as n from l group by all) select brand, max(n) as longest, count(*) as streaks from i group by 1""")
def losing_streaks(spark, sf_dir):
    """A flat trade ends a streak."""
    runs = W.islands(trades(spark, sf_dir), ["brand"], ["ts", "id", "net"], F.col("net") < 0)
    return runs.groupBy("brand").agg(F.max("length").alias("longest"), F.count("*").alias("streaks"))


@query("W11_longest_gap", f"with {TICKS}, g as (select venue, date_diff('microsecond', lag(ts) over (partition by venue order by ts), ts) / 1e6 as gap from ticks) select venue, round(max(gap), 6) as longest from g group by 1")
def longest_gap(spark, sf_dir):
    return W.gaps(ticks(spark, sf_dir), ["venue"]).groupBy("venue").agg(F.round(F.max("gap_seconds"), 6).alias("longest"))


@query("A8_cluster_means", f"""with {NET}, c as (select brand, supplier, avg(net) as m from t group by all), a as (select brand, avg(m) as mean, stddev_samp(m) as sd, count(*) as clusters from c group by 1)
select brand, round(mean, 6) as mean, round(sd, 6) as sd, clusters, round(case when clusters > 1 and sd > 0 then mean / (sd / sqrt(clusters)) end, 6) as z from a""")
def cluster_means(spark, sf_dir):
    return rounded(M.cluster_means(trades(spark, sf_dir), ["brand"], ["supplier"], "net"), 6, "mean", "sd", "z")


@query("A9_panel_return", f"with {HOURLY}, r as (select venue, bucket, close / nullif(open, 0) - 1 as ret from bars) select bucket, round(avg(ret), 6) as panel, count(ret) as members from r where ret is not null group by 1 having count(ret) = 5")
def panel_return(spark, sf_dir):
    r = hourly(spark, sf_dir).withColumn("ret", S.change("close", "open"))
    return rounded(C.panel_mean(r, "bucket", "ret", 5), 6, "panel")


@query("A10_complete_cross_section", f"with {HOURLY} select venue, bucket, close from bars where bucket in (select bucket from bars group by 1 having count(distinct venue) = 5)")
def complete_cross_section(spark, sf_dir):
    return C.complete_only(hourly(spark, sf_dir), "bucket", "venue", 5).select("venue", "bucket", "close")


LADDER = f"with {HOURLY}, r as (select hour(bucket) as phase, close / nullif(open, 0) - 1 as ret from bars), p as (select phase, count(*) as n, avg(ret) as mean, bool_and(ret > -0.9) as strict from r group by 1)"


@query("A11_phase_ladder", LADDER + " select count(*) as phases, count(*) filter (strict) as strict_phases, count(*) filter (mean > 0) as positive_phases, round(median(mean), 6) as median_mean, round(min(mean), 6) as worst_mean from p")
def phase_ladder(spark, sf_dir):
    r = hourly(spark, sf_dir).select(F.hour("bucket").alias("phase"), S.change("close", "open").alias("ret")).withColumn("pass", F.col("ret") > -0.9)
    return rounded(C.phase_ladder(r, "bucket", "ret", "pass")[1], 6, "median_mean", "worst_mean")


@query("A12_daily_t", f"""with {NET}, d as (select brand, cast(ts as date) as day, avg(net) as m from t group by all), a as (select brand, avg(m) as mean, stddev_samp(m) as sd, count(*) as clusters from d group by 1)
select brand, round(mean, 6) as mean, round(sd, 6) as sd, clusters, round(case when clusters > 1 and sd > 0 then mean / (sd / sqrt(clusters)) end, 6) as z from a""")
def daily_t(spark, sf_dir):
    return rounded(M.daily_t(trades(spark, sf_dir), ["brand"], F.to_date("ts"), "net"), 6, "mean", "sd", "z")


@query("A13_economics", "select l_returnflag, round(avg(l_extendedprice * l_discount), 4) as avg_cost, round(avg(l_extendedprice * l_tax), 4) as avg_tax, round(median(l_tax - l_discount), 6) as median_basis, round(quantile_cont(abs(l_tax - l_discount), 0.95), 6) as p95_abs_basis from lineitem group by 1")
def economics(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem").withColumn("basis", F.col("l_tax") - F.col("l_discount")).withColumn("size", F.abs("basis"))
    means = items.groupBy("l_returnflag").agg(F.round(F.avg(F.col("l_extendedprice") * F.col("l_discount")), 4).alias("avg_cost"), F.round(F.avg(F.col("l_extendedprice") * F.col("l_tax")), 4).alias("avg_tax"))
    for value, name, q in (("basis", "median_basis", 0.5), ("size", "p95_abs_basis", 0.95)):
        means = means.join(rounded(Q.percentiles(items, ["l_returnflag"], value, {name: q}), 6, name), "l_returnflag")
    return means


@query("A14_coverage", "select o_orderpriority, count(distinct o_custkey) as customers, count(distinct case when o_orderstatus = 'F' then o_custkey end) as finished, round(count(distinct case when o_orderstatus = 'F' then o_custkey end) / count(distinct o_custkey), 6) as ratio from orders group by 1")
def coverage(spark, sf_dir):
    done = F.count_distinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")))
    out = read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("customers"), done.alias("finished"))
    return out.withColumn("ratio", F.round(S.ratio("finished", "customers"), 6))


@query("A15_status_rollup", "select o_custkey, count(*) as n, count(*) filter (o_orderstatus = 'F') as finished, count(*) filter (o_orderstatus = 'O') as open, min(o_orderdate) filter (o_totalprice > 100000) as first_large, max(o_orderdate) filter (o_totalprice > 100000) as last_large from orders group by 1")
def status_rollup(spark, sf_dir):
    large = F.when(F.col("o_totalprice") > 100_000, F.col("o_orderdate"))
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.count_if(F.col("o_orderstatus") == "O").alias("open"), F.min(large).alias("first_large"), F.max(large).alias("last_large")
    )


@query("A17_latest_per_state", "select o_custkey, arg_max(o_orderkey, {'d': o_orderdate, 'k': o_orderkey}) filter (o_orderstatus = 'F') as last_finished, arg_min(o_orderkey, {'d': o_orderdate, 'k': o_orderkey}) filter (o_orderstatus = 'O') as first_open from orders group by 1")
def latest_per_state(spark, sf_dir):
    o = F.struct("o_orderdate", "o_orderkey")
    in_state = lambda s, x: F.when(F.col("o_orderstatus") == s, x)
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.max_by("o_orderkey", in_state("F", o)).alias("last_finished"), F.min_by("o_orderkey", in_state("O", o)).alias("first_open")
    )


@query("A18_best_per_key", "select l_orderkey, l_linenumber, l_extendedprice from lineitem qualify row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber) = 1")
def best_per_key(spark, sf_dir):
    best = F.max_by(F.struct("l_linenumber", "l_extendedprice"), F.struct("l_extendedprice", -F.col("l_linenumber")))
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(best.alias("b")).select("l_orderkey", "b.*")


@query("A19_high_low_range", f"with {HOURLY} select venue, cast(bucket as date) as day, round(max(high) / min(low) - 1, 6) as width from bars where hour(bucket) >= 6 and hour(bucket) < 18 group by all")
def high_low_range(spark, sf_dir):
    inside = hourly(spark, sf_dir).where((F.hour("bucket") >= 6) & (F.hour("bucket") < 18))
    return inside.groupBy("venue", F.to_date("bucket").alias("day")).agg(F.round(S.quotient(F.max("high"), F.min("low")) - 1, 6).alias("width"))


@query(
    "A20_liquidity_baseline",
    f"""with {TICKS} select e.id, count(o.id) as quotes, round(median(o.price), 6) as median_price, round(quantile_cont(o.price, 0.9), 6) as p90_price, round(median(o.size), 6) as median_depth
  from ticks e left join ticks o on o.entity = e.entity and o.ts >= e.ts - interval 12 hours and o.ts <= e.ts and o.venue = 'view' where e.venue = 'purchase' group by 1""",
)
def liquidity_baseline(spark, sf_dir):
    t = ticks(spark, sf_dir)
    e = t.where("venue = 'purchase'").select("entity", F.col("id").alias("eid"), T.shift("ts", -12 * 3600).alias("start"), F.col("ts").alias("end"))
    found = J.interval_join(t.where("venue = 'view'").select("entity", "ts", "price", "size"), e, ["entity"], 12 * 3600)
    found = materialize(found.select(F.col("eid").alias("id"), "price", "size"), "quotes")
    stats = found.groupBy("id").agg(F.count("*").alias("quotes"))
    for value, points in (("price", {"median_price": 0.5, "p90_price": 0.9}), ("size", {"median_depth": 0.5})):
        stats = stats.join(Q.percentiles(found, ["id"], value, points), "id", "left")
    out = e.select(F.col("eid").alias("id")).join(stats, "id", "left").withColumn("quotes", F.coalesce("quotes", F.lit(0)))
    return rounded(out, 6, "median_price", "p90_price", "median_depth")


@query("A21_live_summary", "select l_linestatus, count(*) as n, round(avg(l_discount), 6) as mean_cost, round(avg((l_discount > 0.05)::int), 6) as hit_rate, round(avg((l_quantity >= 25)::int), 6) as fill_rate from lineitem group by 1")
def live_summary(spark, sf_dir):
    share = lambda c: F.round(F.avg(c.cast("int")), 6)
    return read(spark, sf_dir, "lineitem").groupBy("l_linestatus").agg(
        F.count("*").alias("n"), F.round(F.avg("l_discount"), 6).alias("mean_cost"), share(F.col("l_discount") > 0.05).alias("hit_rate"), share(F.col("l_quantity") >= 25).alias("fill_rate")
    )


@query("A22_feature_vectors", "with k as (select l_orderkey, l_linenumber, max(l_quantity) as q from lineitem group by all) select l_orderkey, count(*) as features, sum(q) as total, max(case when l_linenumber = 1 then q end) as f1 from k group by 1")
def feature_vectors(spark, sf_dir):
    keyed = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    v = keyed.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_linenumber", "q"))).alias("m"))
    return v.select("l_orderkey", F.size("m").cast("long").alias("features"), F.aggregate(F.map_values("m"), F.lit(0.0), lambda a, x: a + x).alias("total"), F.try_element_at("m", F.lit(1)).alias("f1"))


@query("A23_cost_stress", f"with {NET}, c as (select brand, net - k / 10000 as net, k as cost_bp from t, unnest([50.0, 100.0, 200.0]) as u(k)) select brand, cast(cost_bp as double) as cost_bp, count(*) as n, round(avg(net), 6) as mean, round(avg((net > 0)::int), 6) as hit_rate from c group by all")
def cost_stress(spark, sf_dir):
    s = M.cost_stress(trades(spark, sf_dir).withColumnRenamed("net", "gross"), [50, 100, 200])
    return s.groupBy("brand", "cost_bp").agg(F.count("*").alias("n"), F.round(F.avg("net"), 6).alias("mean"), F.round(F.avg((F.col("net") > 0).cast("int")), 6).alias("hit_rate"))


@query("A24_leave_one_out", f"with {NET} select b.brand as left_out, count(*) as n, round(avg(net), 6) as mean, round(avg((net > 0)::int), 6) as hit_rate from (select distinct brand from t) b join t on t.brand <> b.brand group by 1")
def leave_one_out(spark, sf_dir):
    return rounded(M.leave_out(trades(spark, sf_dir), "brand"), 6, "mean", "hit_rate")


@query("A25_readiness", f"with {TICKS} select entity, bool_or(venue = 'purchase') as has_trades, bool_or(venue = 'view') as has_quotes, count(*) filter (venue = 'error') as failures from ticks group by 1 having bool_or(venue = 'purchase') and bool_or(venue = 'view') and count(*) filter (venue = 'error') < 12")
def readiness(spark, sf_dir):
    out = ticks(spark, sf_dir).groupBy("entity").agg(F.bool_or(F.col("venue") == "purchase").alias("has_trades"), F.bool_or(F.col("venue") == "view").alias("has_quotes"), F.count_if(F.col("venue") == "error").alias("failures"))
    return out.where("has_trades and has_quotes and failures < 12")


# ---- rankings, limits, sets --------------------------------------------------------------------------------------------


@query("W7_percent_ranks", f"with {HOURLY} select venue, bucket, round(percent_rank() over (partition by bucket order by volume), 6) as volume_rank, round(percent_rank() over (partition by bucket order by close), 6) as close_rank from bars")
def percent_ranks(spark, sf_dir):
    out = C.percent_ranks(hourly(spark, sf_dir), "bucket", ["volume", "close"])
    return rounded(out.select("venue", "bucket", "volume_rank", "close_rank"), 6, "volume_rank", "close_rank")


@query("W8_double_quintiles", """with d as (select o_orderkey, o_orderpriority, ntile(5) over (partition by o_orderpriority order by o_totalprice, o_orderkey) as a, ntile(5) over (partition by o_orderpriority order by o_custkey, o_orderkey) as b from orders)
select o_orderkey, o_orderpriority from d where a = 5 and b = 5""")
def double_quintiles(spark, sf_dir):
    out = C.tiles(read(spark, sf_dir, "orders"), "o_orderpriority", ["o_totalprice", "o_custkey"], "o_orderkey")
    return out.where("o_totalprice_tile = 5 and o_custkey_tile = 5").select("o_orderkey", "o_orderpriority")


@query("W19_hash_sample", "select brand, k from (select p_brand as brand, p_partkey as k, row_number() over (partition by p_brand order by md5(p_partkey || '|seed7')) as r from part) where r <= 5")
def hash_sample(spark, sf_dir):
    key = F.md5(F.concat(F.col("k").cast("string"), F.lit("|seed7")))
    parts = read(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("k")).withColumn("_h", key)
    return E.cap_per_entity(parts, ["brand"], ["_h"], 5).drop("_h")


@query("W21_ranked_targets", f"""with {TICKS}, l as (select entity, arg_max(price, ts) as score, max(ts) as seen from ticks group by 1), live as (select * from l where seen >= timestamp '2024-01-30')
select entity, score, row_number() over (order by score desc, seen desc, entity) as rank, row_number() over (order by score desc, seen desc, entity) <= 10 as admitted from live""")
def ranked_targets(spark, sf_dir):
    latest = ticks(spark, sf_dir).groupBy("entity").agg(F.max_by("price", "ts").alias("score"), F.max("ts").alias("seen"))
    live = latest.where(F.col("seen") >= F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"))
    # the live set is ranked by range, in no single task
    ranked = Q.places(live.withColumns({"_s": -F.col("score"), "_t": -F.unix_micros(F.col("seen").cast("timestamp"))}), [], ["_s", "_t", "entity"], "rank")
    return ranked.select("entity", "score", "rank", (F.col("rank") <= 10).alias("admitted"))


@query("W24_first_per_day", f"with {TICKS} select entity, ts, id from ticks where price >= 100 qualify row_number() over (partition by entity, cast(ts as date) order by ts, id) = 1")
def first_per_day(spark, sf_dir):
    return E.first_per_day(ticks(spark, sf_dir).where("price >= 100"), ["entity"], F.to_date("ts"), ["ts", "id"]).select("entity", "ts", "id")


@query("O1_cap_per_entity", f"with {TICKS} select entity, id from ticks qualify row_number() over (partition by entity order by ts, id) <= 5")
def entity_cap(spark, sf_dir):
    return E.cap_per_entity(ticks(spark, sf_dir), ["entity"], ["ts", "id"], 5).select("entity", "id")


@query("O2_admission", f"""with {TICKS}, k as (select id, venue, sha256('run|' || entity || '|' || id) as o from ticks), r as (select *, row_number() over (partition by venue order by o) as r from k)
select id, venue, (venue = 'error' and r <= 100) or (venue = 'view' and r <= 300) as admitted, case when (venue = 'error' and r <= 100) or (venue = 'view' and r <= 300) then 'admitted' when venue in ('error', 'view') then 'cap reached' else 'no cap' end as reason from r""")
def admission(spark, sf_dir):
    key = F.concat_ws("|", F.lit("run"), F.col("entity").cast("string"), F.col("id").cast("string"))
    return E.admit(ticks(spark, sf_dir), "venue", key, {"error": 100, "view": 300}).select("id", "venue", "admitted", "reason")


@query("O3_top_n", "select s_suppkey, s_acctbal from supplier order by s_acctbal desc, s_suppkey limit 25")
def top_n(spark, sf_dir):
    return read(spark, sf_dir, "supplier").orderBy(F.desc("s_acctbal"), "s_suppkey").limit(25).select("s_suppkey", "s_acctbal")


@query("O4_round_robin", """with a as (select o_custkey as item, row_number() over (order by max(o_totalprice), o_custkey) as r, 0 as s from orders where o_orderstatus = 'F' group by o_custkey), b as (select o_custkey as item, row_number() over (order by min(o_orderdate), o_custkey) as r, 1 as s from orders group by o_custkey),
u as (select * from a where r <= 40 union all select * from b where r <= 40), m as (select item, min({'r': r, 's': s}) as o from u group by 1)
select item, cast(o.r as int) as turn, o.s as source from m order by o limit 40""")
def round_robin(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    a = o.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("item")).agg(F.max("o_totalprice").alias("k"))
    b = o.groupBy(F.col("o_custkey").alias("item")).agg(F.min("o_orderdate").alias("k"))
    return E.round_robin([a, b], "item", "k", 40)


@query("O5_nearest_pair", """with l as (select l_orderkey as o, l_partkey % 7 as expiry, l_partkey % 10 as strike, l_linenumber % 2 as leg from lineitem), p as (select o, expiry, strike from l group by all having count(distinct leg) = 2)
select o, expiry, strike from p qualify row_number() over (partition by o order by expiry, abs(strike - 4), strike) = 1""")
def nearest_pair(spark, sf_dir):
    legs = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o"), (F.col("l_partkey") % 7).alias("expiry"), (F.col("l_partkey") % 10).alias("strike"), (F.col("l_linenumber") % 2).alias("leg"))
    pairs = legs.groupBy("o", "expiry", "strike").agg(F.count_distinct("leg").alias("legs")).where("legs = 2")
    return pairs.groupBy("o").agg(F.min(F.struct("expiry", F.abs(F.col("strike") - 4).alias("d"), "strike")).alias("b")).select("o", "b.expiry", "b.strike")


@query("O6_top_contributors", f"with {NET} select brand, count(*) as n from t group by 1 order by n desc, brand limit 2")
def top_contributors(spark, sf_dir):
    return M.top_groups(trades(spark, sf_dir), "brand")


@query("O7_union_distinct", f"with {TICKS} select entity, date_trunc('day', ts) as day from ticks where venue = 'view' union select entity, date_trunc('day', ts) + interval 1 day from ticks where venue = 'click'")
def union_distinct(spark, sf_dir):
    t = ticks(spark, sf_dir).withColumn("day", T.floor_to("ts", 86_400))
    entries = t.where("venue = 'view'").select("entity", "day")
    return entries.union(t.where("venue = 'click'").select("entity", T.shift("day", 86_400))).distinct()


@query("O8_union_all", "select 'customer' as family, c_custkey as k, c_acctbal as v from customer union all select 'supplier', s_suppkey, s_acctbal from supplier")
def union_all(spark, sf_dir):
    a = read(spark, sf_dir, "customer").select(F.lit("customer").alias("family"), F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    return a.unionByName(read(spark, sf_dir, "supplier").select(F.lit("supplier").alias("family"), F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v")))


@query("O9_set_operations", "select 'both' as part, k from (select o_custkey as k from orders where o_orderstatus = 'F' intersect select o_custkey from orders where o_orderstatus = 'P') union all select 'only', k from (select o_custkey as k from orders where o_orderstatus = 'F' except select o_custkey from orders where o_orderstatus = 'P')")
def set_operations(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    f, p = (o.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k")) for s in "FP")
    return f.intersect(p).select(F.lit("both").alias("part"), "k").unionByName(f.subtract(p).select(F.lit("only").alias("part"), "k"))


@query("O10_latest_rows", f"with {TICKS} select id, ts, price from ticks order by ts desc, id desc limit 50")
def latest_rows(spark, sf_dir):
    return ticks(spark, sf_dir).orderBy(F.desc("ts"), F.desc("id")).limit(50).select("id", "ts", "price")
