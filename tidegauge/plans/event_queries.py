"""Queries of event selection and outcomes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.functions import scalars as S
from tidegauge.functions import time as T
from tidegauge.operators import events as E
from tidegauge.operators import features as W
from tidegauge.operators import outcomes as X
from tidegauge.operators import xsection as C
from tidegauge.plans.inputs import HOURLY, TICKS, hourly, read, rounded, ticks
from tidegauge.plans.join_queries import HEDGE
from tidegauge.plans.registry import query

NTZ = "timestamp_ntz"


def day(ts: str):
    return F.to_date(ts)


# Greedy folds are recursive in SQL: from each accepted event to the first one at or after its end.
def fold_sql(source: str, by: str, end: str) -> str:
    return f"""f as (select {by}, min(ts) as ts from {source} group by {by}
  union all select f.{by}, (select min(s.ts) from {source} s where s.{by} = f.{by} and s.ts >= {end}) as ts from f where ts is not null)"""


@query("E4_cooldown", f"""with recursive {TICKS}, s as (select * from ticks where price >= 60), {fold_sql("s", "entity", "f.ts + interval 120 hours")}
select s.id, s.entity, s.ts from s join f on f.entity = s.entity and f.ts = s.ts""")
def cooldown(spark, sf_dir):
    return E.cooldown(ticks(spark, sf_dir).where("price >= 60"), ["entity"], 120 * 3600).select("id", "entity", "ts")


@query("E5_non_overlap", f"""with recursive {TICKS}, s as (select *, entity || '/' || venue as key, ts + to_hours(cast(size as int)) as exit_ts from ticks),
f as (select key, min(ts) as ts, arg_min(exit_ts, ts) as exit_ts from s group by 1 union all
  select f.key, n.ts, n.exit_ts from f, lateral (select min(s.ts) as ts, arg_min(s.exit_ts, s.ts) as exit_ts from s where s.key = f.key and s.ts >= f.exit_ts and s.ts > f.ts) n where n.ts is not null)
select s.id, s.entity, s.venue, s.ts, s.exit_ts from s join f on f.key = s.key and f.ts = s.ts""")
def non_overlap(spark, sf_dir):
    t = ticks(spark, sf_dir).withColumn("exit_ts", F.timestamp_add("HOUR", F.col("size").cast("int"), F.col("ts")))
    return E.greedy(t, ["entity", "venue"], "ts", F.col("exit_ts"), "id").select("id", "entity", "venue", "ts", "exit_ts")


RISE = f"""with recursive {HOURLY}, b as (select venue as entity, cast(bucket as date) as d, venue || '/' || cast(bucket as date) as key, bucket as ts, close, close / nullif(first_value(open) over (partition by venue, cast(bucket as date) order by bucket), 0) - 1 as from_open,
  close / nullif(lag(close) over (partition by venue order by bucket), 0) - 1 as ret1, sum(close * volume) over (partition by venue order by bucket rows 4 preceding) as dollars from bars),"""


@query(
    "E1_session_windows",
    RISE
    + """ s as (select *, case when from_open >= 2 then 'open_return' when ret1 >= 1.5 then 'last_return' end as trigger from b where close >= 0.05 and dollars >= 10000 and (from_open >= 2 or ret1 >= 1.5)),
f as (select key, min(ts) as ts from s group by key union all select f.key, (select min(s.ts) from s where s.key = f.key and s.ts >= f.ts + interval 2 hours) from f where ts is not null)
select s.entity, s.ts, s.trigger, s.ts - interval 2 hours as window_start, s.ts + interval 2 hours as window_end from s join f on f.key = s.key and f.ts = s.ts""",
)
def session_windows(spark, sf_dir):
    w = W.series(["entity"], "ts")
    b = hourly(spark, sf_dir).select(F.col("venue").alias("entity"), F.col("bucket").alias("ts"), "open", "close", "volume")
    b = b.withColumns({
        "from_open": W.session_return(["entity"], day("ts"), "ts"), "ret1": S.change("close", F.lag("close").over(w)), "dollars": W.dollar_volume(w), "session": day("ts"), "id": F.unix_seconds(F.col("ts").cast("timestamp")),
    })
    found = E.detect(b, [("open_return", F.col("from_open") >= 2), ("last_return", F.col("ret1") >= 1.5)], (F.col("close") >= 0.05) & (F.col("dollars") >= 10_000))
    kept = E.cooldown(found, ["entity", "session"], 7200)
    return E.windows_around(kept, 7200, 7200).select("entity", "ts", "trigger", "window_start", "window_end")


@query(
    "E2_continuous_windows",
    RISE
    + """ s as (select *, case when ret1 >= 1.5 then 'last_return' when dollars >= 60000 then 'volume' end as trigger from b where close >= 0.05 and (ret1 >= 1.5 or dollars >= 60000)),
f as (select entity, min(ts) as ts from s group by 1 union all select f.entity, (select min(s.ts) from s where s.entity = f.entity and s.ts >= f.ts + interval 2 hours) from f where ts is not null)
select s.entity, s.ts, s.trigger from s join f on f.entity = s.entity and f.ts = s.ts""",
)
def continuous_windows(spark, sf_dir):
    w = W.series(["entity"], "ts")
    b = hourly(spark, sf_dir).select(F.col("venue").alias("entity"), F.col("bucket").alias("ts"), "close", "volume")
    b = b.withColumns({"ret1": S.change("close", F.lag("close").over(w)), "dollars": W.dollar_volume(w), "id": F.unix_seconds(F.col("ts").cast("timestamp"))})
    found = E.detect(b, [("last_return", F.col("ret1") >= 1.5), ("volume", F.col("dollars") >= 60_000)], F.col("close") >= 0.05)
    return E.cooldown(found, ["entity"], 7200).select("entity", "ts", "trigger")


@query(
    "E3_baseline_sample",
    f"""with {TICKS}, g as (select entity, cast(ts as date) as day, list(ts order by ts) as l, sha256('seed|' || entity || '|' || cast(ts as date)) as d from ticks group by all),
h as (select *, ('0x' || d[1:16])::ubigint as u, ('0x' || d[17:32])::ubigint as v from g)
select entity, day, l[cast(v % len(l) as int) + 1] as ts from h where u::double / 18446744073709551615.0::double < 0.2""",
)
def baseline_sample(spark, sf_dir):
    t = ticks(spark, sf_dir).withColumn("day", day("ts"))
    return E.baseline_sample(t, "entity", "day", "ts", 0.2, "seed")


@query(
    "E6_extreme_persistence",
    f"""with {HOURLY}, x as (select venue, bucket, close, high, low, high / nullif(low, 0) - 1 as rng, close / nullif(open, 0) - 1 as ret, (high - close) / high as rejection, close / vwap - 1 as vs_vwap from bars),
r as (select *, percent_rank() over (partition by bucket order by rng) >= 0.75 as extreme from x where rng is not null)
select a.venue, a.bucket, case when a.bucket < timestamp '2024-01-11' then 1 when a.bucket < timestamp '2024-01-21' then 2 else 3 end as block from r a
  join r b on b.venue = a.venue and b.bucket = a.bucket - interval 1 hour left join r c on c.venue = a.venue and c.bucket = a.bucket - interval 5 hours
where a.extreme and b.extreme and not coalesce(c.extreme, false) and a.ret <= 0 and a.rng < b.rng and (a.ret <= -0.1)::int + (a.rejection >= 0.3)::int + (a.vs_vwap <= -0.05)::int >= 2 and a.bucket + interval 8 hours <= timestamp '2024-01-31'""",
)
def extreme_persistence(spark, sf_dir):
    b = hourly(spark, sf_dir)
    x = b.select("venue", "bucket", S.change("high", "low").alias("rng"), S.change("close", "open").alias("ret"), F.col("high_to_close").alias("rejection"), F.col("close_vs_vwap").alias("vs_vwap"))
    r = C.percent_ranks(x, "bucket", ["rng"]).withColumn("extreme", F.col("rng_rank") >= 0.75)
    x = W.exact_lag(r, ["venue"], "bucket", 3600, ["extreme", "rng"], "_1", "inner")
    r = W.exact_lag(x, ["venue"], "bucket", 5 * 3600, ["extreme"], "_5", of=r)
    legs = S.votes([F.col("ret") <= -0.1, F.col("rejection") >= 0.3, F.col("vs_vwap") <= -0.05])
    kept = r.where(F.col("extreme") & F.col("extreme_1") & ~F.coalesce("extreme_5", F.lit(False)) & (F.col("ret") <= 0) & (F.col("rng") < F.col("rng_1")) & (legs >= 2))
    t = lambda s: F.lit(s).cast(NTZ)
    kept = E.censor(kept, T.shift("bucket", 8 * 3600), t("2024-01-31 00:00:00"))
    block = F.when(F.col("bucket") < t("2024-01-11 00:00:00"), 1).when(F.col("bucket") < t("2024-01-21 00:00:00"), 2).otherwise(3)
    return kept.select("venue", "bucket", block.alias("block"))


@query(
    "E7_double_quantile_selection",
    f"""with {HOURLY}, full_hours as (select bucket from bars group by 1 having count(*) = 5), x as (select venue, bucket, close / nullif(lag(close) over (partition by venue order by bucket), 0) - 1 as ret, high / nullif(low, 0) - 1 as rng from bars),
q as (select *, ntile(2) over (partition by bucket order by ret, venue) as a, ntile(2) over (partition by bucket order by rng, venue) as b from x where bucket in (select bucket from full_hours) and ret is not null and rng is not null)
select venue, bucket, bucket + interval 75 minutes as entry_ts, bucket + interval 1515 minutes as exit_ts from q where a = 2 and b = 2""",
)
def double_quantile(spark, sf_dir):
    b = hourly(spark, sf_dir)
    x = b.select("venue", "bucket", S.change("close", F.lag("close").over(W.series(["venue"]))).alias("ret"), S.change("high", "low").alias("rng"))
    whole = C.complete_only(x, "bucket", "venue", 5).dropna(subset=["ret", "rng"])
    kept = C.tiles(whole, "bucket", ["ret", "rng"], "venue", 2).where("ret_tile = 2 and rng_tile = 2")
    return kept.select("venue", "bucket", T.shift("bucket", 75 * 60).alias("entry_ts"), T.shift("bucket", 1515 * 60).alias("exit_ts"))


@query(
    "E8_leader_confirmation",
    f"""with recursive {HOURLY}, r as (select bucket, max(case when venue = 'view' then close / nullif(open, 0) - 1 end) as a, max(case when venue = 'click' then close / nullif(open, 0) - 1 end) as b, max(case when venue = 'purchase' then close / nullif(open, 0) - 1 end) as c from bars group by 1),
k as (select *, coalesce((a >= 0.5 or b >= 0.8) and c > 0, false) and hour(bucket) between 6 and 20 as hot from r), l as (select bucket, hot, lag(bucket) over w as prev, lag(hot) over w as was from k window w as (order by bucket)),
s as (select 1 as one, bucket as ts from l where hot and prev = bucket - interval 1 hour and not was), {fold_sql("s", "one", "f.ts + interval 30 hours")}
select ts as bucket from f where ts is not null""",
)
def leader_confirmation(spark, sf_dir):
    r = hourly(spark, sf_dir).select("venue", "bucket", S.change("close", "open").alias("ret"))
    return E.leader_signals(r, {"view": 0.5, "click": 0.8}, "purchase", F.hour("bucket").between(6, 20), 3600, 30 * 3600).select("bucket")


@query(
    "E9_first_daily_tail",
    f"""with {HOURLY}, r as (select venue, bucket, close / nullif(open, 0) - 1 as ret from bars), l as (select *, lag(ret) over (partition by venue, cast(bucket as date) order by bucket) as before from r)
select venue, bucket, round(ret, 6) as ret from l where ret <= -0.5 and not coalesce(before <= -0.5, false) qualify row_number() over (partition by venue, cast(bucket as date) order by bucket) = 1""",
)
def first_daily_tail(spark, sf_dir):
    r = hourly(spark, sf_dir).select("venue", "bucket", S.change("close", "open").alias("ret"), day("bucket").alias("d"))
    before = F.lag("ret").over(Window.partitionBy("venue", "d").orderBy("bucket"))
    tail = r.withColumn("entered", (F.col("ret") <= -0.5) & ~F.coalesce(before <= -0.5, F.lit(False))).where("entered")
    return rounded(E.first_per_day(tail, ["venue"], day("bucket"), ["bucket"]).select("venue", "bucket", "ret"), 6, "ret")


@query("E10_censored_events", f"with {TICKS} select id, ts from ticks where ts + interval 8 hours + interval 15 minutes <= timestamp '2024-01-25'")
def censored(spark, sf_dir):
    return E.censor(ticks(spark, sf_dir), T.shift("ts", 8 * 3600 + 900), F.lit("2024-01-25 00:00:00").cast(NTZ)).select("id", "ts")


@query(
    "E13_chunked_windows",
    """with s as (select o_orderkey, o_orderdate as start, o_orderdate + to_minutes(cast(floor(o_totalprice / 50) as int)) as "end" from orders), c as (select *, unnest(range(cast(greatest(ceil(date_diff('second', start, "end") / 18000.0), 1) as bigint))) as chunk from s)
select o_orderkey, chunk, start + to_seconds(chunk * 18000) as chunk_start, least(start + to_seconds(chunk * 18000 + 18000), "end") as chunk_end from c""",
)
def chunked_windows(spark, sf_dir):
    minutes = F.floor(F.col("o_totalprice") / 50).cast("int")
    s = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("start"), F.timestamp_add("MINUTE", minutes, F.col("o_orderdate")).alias("end"))
    return E.chunk_windows(s, 300).select("o_orderkey", "chunk", "chunk_start", "chunk_end")


@query(
    "E14_executable_subset",
    """with m as (select o_custkey, cast(date_trunc('month', o_orderdate) as date) as month, min(o_totalprice) < 50000 as available from orders group by all)
select o_orderkey, coalesce(available, false) as executable from orders left join m on m.o_custkey = orders.o_custkey and m.month = cast(date_trunc('month', o_orderdate) - interval 1 month as date)""",
)
def executable_subset(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    month = F.trunc(F.to_date("o_orderdate"), "month")
    evidence = o.groupBy("o_custkey", month.alias("month")).agg((F.min("o_totalprice") < 50_000).alias("available"))
    known = evidence.withColumn("month", F.add_months("month", 1).cast("date"))
    return o.withColumn("month", month).join(known, ["o_custkey", "month"], "left").select("o_orderkey", F.coalesce("available", F.lit(False)).alias("executable"))


# ---- outcomes --------------------------------------------------------------------------------------------------------


@query(
    "X1_forward_mid_returns",
    f"""with {HOURLY}, m as (select venue, bucket, (high + low) / 2 as mid from bars) select e.venue, e.bucket, cast(h as int) as horizon, round(x.mid / nullif(e.mid, 0) - 1, 6) as gross from m e, unnest([3600, 7200, 21600]) as t(h), m x where x.venue = e.venue and x.bucket = e.bucket + to_seconds(h)""",
)
def forward_mid(spark, sf_dir):
    m = hourly(spark, sf_dir).select("venue", "bucket", ((F.col("high") + F.col("low")) / 2).alias("mid"))
    return rounded(X.forward_outcomes(m, ["venue"], "bucket", [3600, 7200, 21_600], "mid", "mid").select("venue", "bucket", "horizon", "gross"), 6, "gross")


@query(
    "X2_crossing_returns",
    f"""with {HOURLY} select e.venue, e.bucket, cast(h as int) as horizon, round(x.low / nullif(e.high, 0) - 1, 6) as long_return, round(e.low / nullif(x.high, 0) - 1, 6) as short_return, round((e.high - e.low) / ((e.high + e.low) / 2) * 10000, 4) as entry_spread_bps,
  round((x.high - x.low) / ((x.high + x.low) / 2) * 10000, 4) as exit_spread_bps from bars e, unnest([3600, 7200]) as t(h), bars x where x.venue = e.venue and x.bucket = e.bucket + to_seconds(h)""",
)
def crossing(spark, sf_dir):
    q = hourly(spark, sf_dir).select("venue", "bucket", F.col("low").alias("bid"), F.col("high").alias("ask"))
    out = X.crossing_returns(q, ["venue"], "bucket", [3600, 7200]).select("venue", "bucket", "horizon", "long_return", "short_return", "entry_spread_bps", "exit_spread_bps")
    return rounded(rounded(out, 6, "long_return", "short_return"), 4, "entry_spread_bps", "exit_spread_bps")


@query(
    "X3_close_to_close",
    f"with {HOURLY} select e.venue, e.bucket, cast(h as int) as horizon, round(x.close / nullif(e.close, 0) - 1, 6) as gross from bars e, unnest([3600, 14400]) as t(h), bars x where x.venue = e.venue and x.bucket = e.bucket + to_seconds(h)",
)
def close_to_close(spark, sf_dir):
    return rounded(X.forward_outcomes(hourly(spark, sf_dir), ["venue"], "bucket", [3600, 14_400], "close", "close").select("venue", "bucket", "horizon", "gross"), 6, "gross")


HEDGED = f"""with {HOURLY}, {HEDGE}, o as (select e.venue, e.bucket, a.close as entry_price, x.close as exit_price, a.bucket as entry_ts, x.bucket as exit_ts, hx.hedge_close / nullif(ha.hedge_close, 0) - 1 as hedge_return from bars e
  join bars a on a.venue = e.venue and a.bucket = e.bucket + interval 1 hour join bars x on x.venue = e.venue and x.bucket = e.bucket + interval 9 hours join h ha on ha.bucket = a.bucket join h hx on hx.bucket = x.bucket),
g as (select *, 1 - exit_price / nullif(entry_price, 0) + 0.75 * hedge_return as gross from o)"""


def hedged_trades(spark, sf_dir):
    bars = hourly(spark, sf_dir).select("venue", F.col("bucket").alias("ts"), "close")
    hedge = bars.groupBy("ts").agg(F.avg("close").alias("hedge_close"))
    return X.hedged(bars.select("venue", "ts"), bars, ["venue"], 3600, 8 * 3600, 0.75, 0.0022, hedge), bars


@query("X4_hedged_outcomes", HEDGED + " select venue, bucket, round(gross, 6) as gross, round(gross - 0.0022, 6) as net from g")
def hedged_outcomes(spark, sf_dir):
    out, _ = hedged_trades(spark, sf_dir)
    return rounded(out.select("venue", F.col("ts").alias("bucket"), "gross", "net"), 6, "gross", "net")


@query(
    "X5_excursions",
    HEDGED
    + """, p as (select g.*, unnest(range(9)) as k from g) select p.venue, p.bucket, count(b.close) as points, case when count(b.close) = 9 then round(min(1 - b.close / nullif(p.entry_price, 0)), 6) end as mae, case when count(b.close) = 9 then round(max(1 - b.close / nullif(p.entry_price, 0)), 6) end as mfe
  from p left join bars b on b.venue = p.venue and b.bucket = p.entry_ts + to_hours(k) group by p.venue, p.bucket""",
)
def excursions(spark, sf_dir):
    out, bars = hedged_trades(spark, sf_dir)
    keyed = out.withColumn("id", F.concat_ws("/", "venue", F.col("ts").cast("string")))
    path = X.excursions(keyed, bars, ["venue"], 3600)
    return rounded(keyed.join(path, "id").select("venue", F.col("ts").alias("bucket"), "points", "mae", "mfe"), 6, "mae", "mfe")


@query(
    "X6_study_expansion",
    HEDGED + " select venue, bucket, structure, mode, round(case structure when 'hedged' then gross else gross - 0.75 * hedge_return end, 6) as gross from g, (values ('hedged'), ('plain')) s(structure), (values ('all'), ('non_overlap')) m(mode)",
)
def study_expansion(spark, sf_dir):
    out, _ = hedged_trades(spark, sf_dir)
    dims = F.broadcast(spark.createDataFrame([(s, m) for s in ("hedged", "plain") for m in ("all", "non_overlap")], "structure string, mode string"))  # four rows
    plain = F.col("gross") - 0.75 * F.col("hedge_return")
    return rounded(out.crossJoin(dims).withColumn("gross", F.when(F.col("structure") == "hedged", F.col("gross")).otherwise(plain)).select("venue", F.col("ts").alias("bucket"), "structure", "mode", "gross"), 6, "gross")


@query(
    "X7_metrics_by_block",
    HEDGED
    + """, b as (select *, case when bucket < timestamp '2024-01-11' then 'first' when bucket < timestamp '2024-01-21' then 'second' else 'third' end as block from g)
select coalesce(block, 'all') as block, count(*) as n, round(avg(gross), 6) as mean, round(avg((gross > 0)::int), 6) as hit_rate from b group by grouping sets ((block), ())""",
)
def metrics_by_block(spark, sf_dir):
    out, _ = hedged_trades(spark, sf_dir)
    t = lambda s: F.lit(s).cast(NTZ)
    block = F.when(F.col("ts") < t("2024-01-11 00:00:00"), "first").when(F.col("ts") < t("2024-01-21 00:00:00"), "second").otherwise("third")
    g = out.withColumn("block", block).groupingSets([["block"], []], "block").agg(F.count("*").alias("n"), F.avg("gross").alias("mean"), F.avg((F.col("gross") > 0).cast("int")).alias("hit_rate"))
    return rounded(g.withColumn("block", F.coalesce("block", F.lit("all"))), 6, "mean", "hit_rate")


@query(
    "X8_relative_economics",
    f"""with {HOURLY}, p as (select venue, bucket, close, close / nullif(vwap, 0) - 1 as basis from bars), t as (select e.venue, e.bucket, 1 - x.close / nullif(e.close, 0) as perp, e.basis * 10000 as entry_basis_bps, x.basis * 10000 as exit_basis_bps, x.bucket as exit_ts from p e join p x on x.venue = e.venue and x.bucket = e.bucket + interval 24 hours),
f as (select t.venue, t.bucket, coalesce(sum(b.volume / 100000), 0) as funding from t left join bars b on b.venue = t.venue and b.bucket > t.bucket and b.bucket <= t.exit_ts and hour(b.bucket) % 8 = 0 group by all)
select t.venue, t.bucket, round(perp, 6) as perp, round(funding, 6) as funding, round(perp + funding, 6) as total, round(entry_basis_bps, 4) + 0.0 as entry_basis_bps, round(exit_basis_bps, 4) + 0.0 as exit_basis_bps from t join f using (venue, bucket)""",
)
def relative_economics(spark, sf_dir):
    bars = hourly(spark, sf_dir)
    p = bars.select("venue", "bucket", "close", (F.col("close_vs_vwap") * 10_000).alias("basis"))
    later = p.select("venue", F.col("bucket").alias("exit_ts"), F.col("close").alias("exit_close"), F.col("basis").alias("exit_basis_bps"))
    t = p.withColumn("exit_ts", T.shift("bucket", 86_400)).join(later, ["venue", "exit_ts"])
    t = t.withColumns({"perp": -S.change("exit_close", "close"), "id": F.concat_ws("/", "venue", F.col("bucket").cast("string"))})
    payments = bars.where(F.hour("bucket") % 8 == 0).select("venue", F.col("bucket").alias("ts"), (F.col("volume") / 100_000).alias("rate"))
    paid = X.band_sum(t, payments, ["venue"], "rate", start="bucket", end="exit_ts")
    out = paid.select("venue", "bucket", "perp", F.col("paid").alias("funding"), (F.col("perp") + F.col("paid")).alias("total"), F.col("basis").alias("entry_basis_bps"), "exit_basis_bps")
    return rounded(rounded(out, 6, "perp", "funding", "total"), 4, "entry_basis_bps", "exit_basis_bps")


@query(
    "X9_two_leg_outcome",
    """with l as (select l_orderkey, l_linenumber, min(l_extendedprice) as price from lineitem group by all) select o_orderkey, a.price + b.price as entry, case when a.price is not null and b.price is not null and c.price is not null then round(c.price * 2 / (a.price + b.price) - 1, 6) end as ret,
  array_to_string(list_filter([case when a.price is null then '1' end, case when b.price is null then '2' end, case when c.price is null then '3' end], lambda x: x is not null), ',') as missing
  from orders left join l a on a.l_orderkey = o_orderkey and a.l_linenumber = 1 left join l b on b.l_orderkey = o_orderkey and b.l_linenumber = 2 left join l c on c.l_orderkey = o_orderkey and c.l_linenumber = 3""",
)
def two_leg_outcome(spark, sf_dir):
    legs = read(spark, sf_dir, "lineitem").where("l_linenumber <= 3").groupBy(F.col("l_orderkey").alias("o_orderkey")).pivot("l_linenumber", [1, 2, 3]).agg(F.min("l_extendedprice"))
    j = read(spark, sf_dir, "orders").select("o_orderkey").join(legs, "o_orderkey", "left")
    a, b, c = (F.col(f"`{i}`") for i in (1, 2, 3))
    present = F.array_compact(F.array(*(F.when(x.isNotNull(), F.lit(str(i))) for i, x in enumerate((a, b, c), 1))))
    missing = F.array_except(F.array(F.lit("1"), F.lit("2"), F.lit("3")), present)
    return j.select("o_orderkey", (a + b).alias("entry"), F.round(c * 2 / (a + b) - 1, 6).alias("ret"), F.concat_ws(",", missing).alias("missing"))


ASKS = "asks as (select l_orderkey, l_linenumber, l_partkey, l_extendedprice / l_quantity as price, l_quantity as amount from lineitem)"


GRID = (25_000.0, 50_000.0, 100_000.0, 250_000.0, 500_000.0)
SWEEP_SQL = f"""{ASKS}, w as (select *, coalesce(sum(price * amount) over (partition by l_orderkey order by price, l_linenumber, l_partkey, amount rows between unbounded preceding and 1 preceding), 0) as before from asks),
x as (select *, greatest(0, least(price * amount, notional - before)) as spent from w, unnest([25000::double, 50000, 100000, 250000, 500000]) as g(notional)), a as (select l_orderkey, notional, sum(spent) as filled, sum(spent / price) as q from x group by all),
e as (select l_orderkey, notional, notional - filled <= 1e-9 as depth_ok, greatest(notional - filled, 0) as unfilled, case when notional - filled <= 1e-9 then q end as quantity, case when notional - filled <= 1e-9 then filled / q end as vwap from a)"""


def order_book(spark, sf_dir):
    """An order's lines as ask levels."""
    return read(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_quantity").alias("k"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("amount"))


@query("X10_book_sweep", f"with {SWEEP_SQL} select l_orderkey, notional, depth_ok, round(unfilled, 4) as unfilled, round(quantity, 6) as quantity, round(vwap, 6) as vwap from e")
def book_sweep(spark, sf_dir):
    out = X.sweep(order_book(spark, sf_dir), ["l_orderkey"], GRID, F.col("price"), "k")
    return rounded(rounded(out, 4, "unfilled"), 6, "quantity", "vwap")


@query(
    "X10_capacity_returns",
    f"""with {SWEEP_SQL}, b as (select l_orderkey, l_linenumber, price * 1.01 as price, amount * 0.75 as amount, coalesce(sum(amount * 0.75) over (partition by l_orderkey order by price * 1.01 desc, l_linenumber, l_partkey, amount rows between unbounded preceding and 1 preceding), 0) as before from asks),
s as (select e.l_orderkey, e.notional, e.quantity, sum(greatest(0, least(b.amount, e.quantity - b.before))) as sold, sum(greatest(0, least(b.amount, e.quantity - b.before)) * b.price) as p from e join b using (l_orderkey) where e.quantity is not null group by all)
select e.l_orderkey, e.notional, coalesce(s.quantity - sold <= 1e-9 and sold > 0, false) as depth_ok, case when s.quantity - sold <= 1e-9 and sold > 0 then round(p, 4) end as proceeds, case when s.quantity - sold <= 1e-9 and sold > 0 then round(p / e.notional - 1, 6) end as "return" from e left join s using (l_orderkey, notional)""",
)
def capacity_returns(spark, sf_dir):
    """What each notional bought is sold through bids one per cent above the asks, of three quarters of their size."""
    asks = order_book(spark, sf_dir)
    bids = asks.select("l_orderkey", "k", (F.col("price") * 1.01).alias("price"), (F.col("amount") * 0.75).alias("amount"))
    out = X.capacity_returns(X.sweep(asks, ["l_orderkey"], GRID, F.col("price"), "k"), bids, ["l_orderkey"], F.desc("price"), "k")
    return rounded(rounded(out.drop("vwap"), 4, "proceeds"), 6, "return")


@query(
    "X10_book_sell_sweep",
    f"""with {ASKS}, w as (select *, coalesce(sum(amount) over (partition by l_orderkey order by price desc, l_linenumber, l_partkey rows between unbounded preceding and 1 preceding), 0) as before from asks),
x as (select *, greatest(0, least(amount, 60 - before)) as s from w) select l_orderkey, sum(s) as sold, case when 60 - sum(s) <= 1e-9 then round(sum(s * price), 7) end as proceeds from x group by 1""",
)
def book_sell_sweep(spark, sf_dir):
    bids = read(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey").alias("k"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("amount"), F.lit(60.0).alias("quantity"))
    return rounded(X.sell_sweep(bids, ["l_orderkey"], "quantity", F.desc("price"), "k"), 7, "proceeds")


@query(
    "X11_passive_fill",
    f"""with {HOURLY}, o as (select venue, bucket, close * 0.5 as lim from bars) select o.venue, o.bucket, min(b.bucket) as fill_ts from o left join bars b on b.venue = o.venue and b.bucket >= o.bucket + interval 1 hour and b.bucket < o.bucket + interval 6 hours and b.low <= o.lim group by all""",
)
def passive_fill(spark, sf_dir):
    bars = hourly(spark, sf_dir).select("venue", F.col("bucket").alias("ts"), "close", "low")
    orders = bars.select("venue", F.col("ts").alias("bucket"), T.shift("ts", 3600).alias("ts"), (F.col("close") * 0.5).alias("limit"), F.concat_ws("/", "venue", F.col("ts").cast("string")).alias("id"))
    return X.passive_fill(orders, bars, ["venue"], 5, 3600).select("venue", "bucket", "fill_ts")


@query(
    "X12_live_returns",
    f"""with {HOURLY}, r as (select e.venue, e.bucket, x.low / nullif(e.high, 0) - 1 as crossed, (x.high + x.low) / nullif(e.high + e.low, 0) - 1 as mid from bars e join bars x on x.venue = e.venue and x.bucket = e.bucket + interval 2 hours)
select venue, bucket, round(crossed, 6) as crossed, round(mid, 6) as mid, round(mid - 0.002, 6) as mid_20bp, round(mid - 0.003, 6) as mid_30bp from r""",
)
def live_returns(spark, sf_dir):
    q = hourly(spark, sf_dir).select("venue", "bucket", F.col("low").alias("bid"), F.col("high").alias("ask"))
    r = X.crossing_returns(q, ["venue"], "bucket", [7200])
    m = S.change(F.col("exit_bid") + F.col("exit_ask"), F.col("bid") + F.col("ask"))
    out = r.select("venue", "bucket", F.col("long_return").alias("crossed"), m.alias("mid"), (m - 0.002).alias("mid_20bp"), (m - 0.003).alias("mid_30bp"))
    return rounded(out, 6, "crossed", "mid", "mid_20bp", "mid_30bp")


@query("X13_outcome_adapter", f"with {TICKS} select venue || ':' || entity as scope, ts as decision_ts, cast(size * 60 as int) as horizon_seconds, round(price / 100, 6) as gross from ticks where size > 0")
def outcome_adapter(spark, sf_dir):
    t = ticks(spark, sf_dir).where("size > 0")
    return t.select(F.concat("venue", F.lit(":"), F.col("entity").cast("string")).alias("scope"), F.col("ts").alias("decision_ts"), (F.col("size") * 60).cast("int").alias("horizon_seconds"), F.round(F.col("price") / 100, 6).alias("gross"))
