"""Queries of discovery screens, falsification, robustness and holdouts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions import scalars as S
from tidegauge.functions import time as T
from tidegauge.operators import events as E
from tidegauge.operators import features as W
from tidegauge.operators import metrics as M
from tidegauge.operators import outcomes as X
from tidegauge.operators import placebo as R
from tidegauge.operators import quality as Q
from tidegauge.operators import screen as D
from tidegauge.operators import xsection as C
from tidegauge.operators.scratch import materialize, scratch_path
from tidegauge.plans.event_queries import NTZ
from tidegauge.plans.inputs import HOURLY, TICKS, hourly, read, rounded, ticks
from tidegauge.plans.join_queries import NET, trades
from tidegauge.plans.registry import query

CONFIG = D.ScreenConfig(
    discovery=(datetime(2024, 1, 1), datetime(2024, 1, 19)), validation=(datetime(2024, 1, 19), datetime(2024, 1, 31)),
    quantiles=(0.05, 0.1, 0.2), cost=0.002, min_discovery=20, min_validation=10, min_hit=0.4,
)

CUTS = " union all ".join(
    f"select feature_key, {q}::double as quantile, '{tail}' as tail, quantile_cont(value, {x}) as threshold from feats where phase = 'discovery' group by 1"
    for q in (0.05, 0.1, 0.2)
    for tail, x in (("LOW", q), ("HIGH", 1 - q))
)

PANEL_SQL = f"""{HOURLY},
wide as (select venue, bucket, case when lag(bucket, 1) over w = bucket - interval 1 hour then close / nullif(lag(close, 1) over w, 0) - 1 end as ret1, high / nullif(low, 0) - 1 as width, close / vwap - 1 as vs_vwap, volume,
  case when bucket < timestamp '2024-01-19' then 'discovery' when bucket < timestamp '2024-01-31' then 'validation' end as phase from bars window w as (partition by venue order by bucket)),
feats as (select venue, bucket, phase, feature_key, value from wide unpivot (value for feature_key in (ret1, width, vs_vwap, volume))),
outs as (select e.venue, e.bucket, cast(h as int) as horizon, x.close / nullif(e.close, 0) - 1 as gross from bars e, unnest([3600, 14400, 86400]) as t(h), bars x where x.venue = e.venue and x.bucket = e.bucket + to_seconds(h)),
cuts as ({CUTS}),
ev as (select f.*, c.quantile, c.tail, c.threshold, o.horizon, o.gross from feats f join cuts c using (feature_key) join outs o using (venue, bucket) where (tail = 'LOW' and value <= threshold) or (tail = 'HIGH' and value >= threshold)),
dir as (select feature_key, quantile, tail, horizon, cast(sign(avg(gross)) as int) as direction from ev where phase = 'discovery' group by all having count(*) >= 20),
scored as (select ev.*, direction, direction * gross - 0.002 as net from ev join dir using (feature_key, quantile, tail, horizon)),
tests as (select feature_key, quantile, tail, horizon, direction, count(net) filter (phase = 'discovery') as n_discovery, avg(net) filter (phase = 'discovery') as mean_discovery, count(net) filter (phase = 'validation') as n_validation,
  avg(net) filter (phase = 'validation') as mean_validation, avg((net > 0)::int) filter (phase = 'validation') as hit_validation, min(net) filter (phase = 'validation') as worst_validation, stddev_samp(net) filter (phase = 'validation') as sd_validation from scored group by all),
judged as (select *, case when n_validation > 1 and sd_validation > 0 then mean_validation / (sd_validation / sqrt(n_validation)) end as z, coalesce(mean_validation > 0 and n_validation >= 10 and hit_validation >= 0.4, false) as passes from tests)"""


def panel(spark: SparkSession, sf_dir: str, config: D.ScreenConfig = CONFIG) -> tuple[DataFrame, DataFrame]:
    """Hourly features of each venue in long form with their phase, and outcomes at three horizons."""
    bars = hourly(spark, sf_dir)
    w = W.series(["venue"])
    wide = bars.select(
        "venue", "bucket", W.lag_returns(w, {"ret1": 1}, ts="bucket", step=3600)["ret1"].alias("ret1"), S.change("high", "low").alias("width"), F.col("close_vs_vwap").alias("vs_vwap"), "volume",
        D.phase_of(F.col("bucket"), config).alias("phase"),
    )
    features = wide.unpivot(["venue", "bucket", "phase"], ["ret1", "width", "vs_vwap", "volume"], "feature_key", "value").where("value is not null")
    outcomes = X.forward_outcomes(bars, ["venue"], "bucket", [3600, 14_400, 86_400], "close", "close").select("venue", "bucket", "horizon", "gross")
    return features, outcomes


COLUMNS = ["feature_key", "quantile", "tail", "horizon", "direction", "n_discovery", "mean_discovery", "n_validation", "mean_validation", "hit_validation", "worst_validation", "sd_validation", "z", "passes"]
ROUNDED = ["mean_discovery", "mean_validation", "hit_validation", "worst_validation", "sd_validation", "z"]


@query(
    "D2_tail_screen",
    f"with {PANEL_SQL} select feature_key, quantile, tail, horizon, direction, n_discovery, round(mean_discovery, 6) as mean_discovery, n_validation, round(mean_validation, 6) as mean_validation, round(hit_validation, 6) as hit_validation, round(worst_validation, 6) as worst_validation, round(sd_validation, 6) as sd_validation, round(z, 6) as z, passes from judged",
)
def tail_screen_events(spark, sf_dir):
    features, outcomes = panel(spark, sf_dir)
    return rounded(D.tail_screen(features, outcomes, CONFIG, ["venue", "bucket"]).select(*COLUMNS), 6, *ROUNDED)


CROSS = PANEL_SQL.replace(
    "ev as (select f.*, c.quantile, c.tail, c.threshold, o.horizon, o.gross from feats f join cuts c using (feature_key) join outs o using (venue, bucket) where (",
    "ev as (select f.*, c.quantile, c.tail, c.threshold, o.horizon, o.gross, o.venue as target from feats f join cuts c using (feature_key) join outs o on o.bucket = f.bucket and o.venue <> f.venue where (",
)


@query("D1_cross_asset_screen", f"with {CROSS} select feature_key, quantile, tail, horizon, direction, n_discovery, n_validation, round(mean_validation, 6) as mean_validation, round(z, 6) as z, passes from judged")
def cross_asset_screen(spark, sf_dir):
    features, outcomes = panel(spark, sf_dir)
    out = D.peer_screen(features, outcomes, CONFIG, "venue", "bucket")
    return rounded(out.select("feature_key", "quantile", "tail", "horizon", "direction", "n_discovery", "n_validation", "mean_validation", "z", "passes"), 6, "mean_validation", "z")


@query(
    "D3_sided_screen",
    f"""with {PANEL_SQL}, sides as (select ev.*, side, side * gross - 0.001 - 0.002 as net from ev, (values (1), (-1)) s(side))
select feature_key, quantile, tail, horizon, side, count(*) filter (phase = 'discovery') as n_discovery, round(avg(net) filter (phase = 'discovery'), 6) as mean_discovery, count(*) filter (phase = 'validation') as n_validation, round(avg(net) filter (phase = 'validation'), 6) as mean_validation from sides group by all""",
)
def sided_screen(spark, sf_dir):
    features, outcomes = panel(spark, sf_dir)
    events = D.tail_events(features, D.thresholds(features, CONFIG.quantiles)).join(outcomes, ["venue", "bucket"])
    sided = events.withColumn("side", F.explode(F.array(F.lit(1), F.lit(-1)))).withColumn("net", F.col("side") * F.col("gross") - 0.001 - 0.002)
    own = lambda p: F.when(F.col("phase") == p, F.col("net"))
    g = sided.groupBy(*D.TEST, "side").agg(F.count(own("discovery")).alias("n_discovery"), F.avg(own("discovery")).alias("mean_discovery"), F.count(own("validation")).alias("n_validation"), F.avg(own("validation")).alias("mean_validation"))
    return rounded(g, 6, "mean_discovery", "mean_validation")


@query(
    "D4_clustered_screen",
    f"""with {PANEL_SQL}, m as (select feature_key, quantile, tail, horizon, direction, venue, cast(bucket as date) as day, avg(net) as m from scored where phase = 'validation' group by all),
a as (select feature_key, quantile, tail, horizon, direction, avg(m) as mean, stddev_samp(m) as sd, count(*) as clusters from m group by all)
select feature_key, quantile, tail, horizon, direction, clusters, round(case when clusters > 1 and sd > 0 then mean / (sd / sqrt(clusters)) end, 6) as z from a""",
)
def clustered_screen(spark, sf_dir):
    features, outcomes = panel(spark, sf_dir)
    out = D.tail_screen(features.withColumn("day", F.to_date("bucket")), outcomes, CONFIG, ["venue", "bucket"], cluster=["venue", "day"])
    return rounded(out.where("clusters is not null").select(*D.TEST, "direction", "clusters", "z"), 6, "z")


@query(
    "D5_cluster_recompute",
    f"""with {CROSS}, m as (select feature_key, quantile, tail, horizon, direction, venue, cast(bucket as date) as day, avg(net) as m from scored where phase = 'validation' group by all)
select feature_key, quantile, tail, horizon, round(avg(m), 6) as mean, round(stddev_samp(m), 6) as sd, count(*) as clusters from m group by all""",
)
def cluster_recompute(spark, sf_dir):
    features, outcomes = panel(spark, sf_dir)
    events = D.tail_events(features, D.thresholds(features, CONFIG.quantiles))
    events = D.peers_scored(D.peer_sums(events, outcomes, "venue", "bucket", CONFIG.cost), CONFIG)
    out = D.peer_cluster_means(events.where("phase = 'validation'").withColumn("day", F.to_date("bucket")), D.TEST, ["venue", "day"])
    return rounded(out.drop("z"), 6, "mean", "sd")


@query("D6_learned_directions", f"with {PANEL_SQL} select feature_key, quantile, tail, horizon, cast(sign(avg(gross)) as int) as direction, count(*) as n from ev where phase = 'discovery' group by all having count(*) >= 20")
def learned_directions(spark, sf_dir):
    features, outcomes = panel(spark, sf_dir)
    events = D.tail_events(features, D.thresholds(features, CONFIG.quantiles)).join(outcomes, ["venue", "bucket"]).where("phase = 'discovery'")
    return events.groupBy(*D.TEST).agg(F.signum(F.avg("gross")).cast("int").alias("direction"), F.count("*").alias("n")).where("n >= 20")


@query("D7_validation_pass", f"with {PANEL_SQL} select feature_key, count(*) as tests, count(*) filter (passes) as passed from judged group by 1")
def validation_pass(spark, sf_dir):
    features, outcomes = panel(spark, sf_dir)
    return D.tail_screen(features, outcomes, CONFIG, ["venue", "bucket"]).groupBy("feature_key").agg(F.count("*").alias("tests"), F.count_if("passes").alias("passed"))


@query("E11_tail_events", f"with {PANEL_SQL} select feature_key, quantile, tail, count(*) as n, round(any_value(threshold), 6) as threshold from feats join cuts using (feature_key) where (tail = 'LOW' and value <= threshold) or (tail = 'HIGH' and value >= threshold) group by all")
def tail_events(spark, sf_dir):
    features, _ = panel(spark, sf_dir)
    events = D.tail_events(features, D.thresholds(features, CONFIG.quantiles))
    return events.groupBy("feature_key", "quantile", "tail").agg(F.count("*").alias("n"), F.round(F.first("threshold"), 6).alias("threshold"))


BRANDS = f"{NET}, b as (select brand, avg(net) as mean, stddev_samp(net) as sd, count(*) as n from t group by 1), pr as (select brand, 1 / (1 + exp(mean / (sd / sqrt(n)))) as p from b)"


def brand_tests(spark, sf_dir):
    """A test per brand with a logistic stand-in for p, which SQL can compute."""
    b = trades(spark, sf_dir).groupBy("brand").agg(F.avg("net").alias("mean"), F.stddev_samp("net").alias("sd"), F.count("*").alias("n"))
    return b.select("brand", (1 / (1 + F.exp(F.col("mean") / (F.col("sd") / F.sqrt("n"))))).alias("p"))


@query(
    "W18_bh_qvalues",
    f"with {BRANDS}, r as (select *, row_number() over (order by p, brand) as r, count(*) over () as m from pr) select brand, round(p, 8) as p, round(min(least(1, p * m / r)) over (order by r rows between current row and unbounded following), 8) as q from r",
)
def bh_qvalues(spark, sf_dir):
    return rounded(D.bh_qvalues(brand_tests(spark, sf_dir), tie=["brand"]).select("brand", "p", "q"), 8, "p", "q")


@query(
    "W17_neighbour_horizons",
    f"""with {PANEL_SQL}, n as (select *, lag(mean_validation) over w as b, lead(mean_validation) over w as a from judged window w as (partition by feature_key, quantile, tail order by horizon))
select feature_key, quantile, tail, horizon, (a is null and b is null) or coalesce(b > 0, false) or coalesce(a > 0, false) as neighbour_ok from n""",
)
def neighbour_horizons(spark, sf_dir):
    features, outcomes = panel(spark, sf_dir)
    return D.neighbours(D.tail_screen(features, outcomes, CONFIG, ["venue", "bucket"])).select(*D.TEST, "neighbour_ok")


@query(
    "D9_frozen_candidates",
    f"""with {BRANDS}, r as (select *, row_number() over (order by p, brand) as r, count(*) over () as m from pr), q as (select brand, min(least(1, p * m / r)) over (order by r rows between current row and unbounded following) as q from r)
select brand, 'C-' || upper(substr(md5(brand || '|1'), 1, 12)) as candidate_id, sha256(brand || '|1') as definition_hash, case when q <= 0.05 then 'strong' else 'supported' end as tier from q where q <= 0.5""",
)
def frozen_candidates(spark, sf_dir):
    q = D.bh_qvalues(brand_tests(spark, sf_dir), tie=["brand"])
    ready = q.withColumns({"direction": F.lit(1), "mean_validation": F.lit(1.0), "passes": F.lit(True), "neighbour_ok": F.lit(True)})
    return D.freeze(ready, 0.5, key=["brand"]).select("brand", "candidate_id", "definition_hash", "tier")


@query(
    "D10_dependence_review",
    f"""with {NET}, c as (select brand, supplier, avg(net) as m from t group by all), a as (select brand, avg(m) as mean, stddev_samp(m) as sd, count(*) as clusters from c group by 1)
select brand, clusters, round(case when clusters > 1 and sd > 0 then mean / (sd / sqrt(clusters)) end, 6) as z, coalesce(clusters >= 8 and mean / (sd / sqrt(clusters)) >= 1.6448536269514722, false) as passes from a""",
)
def dependence_review(spark, sf_dir):
    return rounded(D.dependence_review(trades(spark, sf_dir), ["brand"], "supplier", "net").select("brand", "clusters", "z", "passes"), 6, "z")


def frozen(tests: DataFrame, features: DataFrame, config: D.ScreenConfig) -> DataFrame:
    """The tests of the 10 % tails at one hour as candidates."""
    cuts = D.thresholds(features, config.quantiles)
    return tests.where("horizon = 3600 and quantile = 0.1").join(cuts, ["feature_key", "quantile", "tail"]).withColumn("candidate_id", F.concat_ws("/", "feature_key", "tail"))


BOTH = ("discovery", "validation")
BATTERY_SQL = ", ".join(f"avg({c}) filter (phase = '{p}') as {n}_{p}" for p in BOTH for n, c in (("base", "x - 0.002"), ("bp50", "x - 0.005"), ("bp100", "x - 0.01"), ("inverse", "-x - 0.002")))
BATTERY = [f"{n}_{p}" for p in BOTH for n in ("base", "bp50", "bp100", "inverse", "week_mean", "placebo", "other_target")]


@query(
    "D11_preholdout_battery",
    f"""with {PANEL_SQL}, cand as (select feature_key || '/' || tail as candidate_id, feature_key, quantile, tail, horizon, direction from judged where horizon = 3600 and quantile = 0.1),
te as (select c.candidate_id, f.venue, f.bucket, f.phase, c.direction from feats f join cand c using (feature_key) join cuts u using (feature_key, quantile, tail) where f.phase is not null and ((c.tail = 'LOW' and value <= u.threshold) or (c.tail = 'HIGH' and value >= u.threshold))),
e as (select te.*, direction * o.gross as x from te join outs o on o.venue = te.venue and o.bucket = te.bucket and o.horizon = 3600), m as (select candidate_id, {BATTERY_SQL} from e group by 1),
wk as (select candidate_id, phase, date_trunc('week', bucket) as week, avg(x - 0.002) as w from e group by all), wa as (select candidate_id, count(w) filter (phase = 'discovery') as weeks_discovery, count(w) filter (phase = 'validation') as weeks_validation,
  avg(w) filter (phase = 'discovery') as week_mean_discovery, avg(w) filter (phase = 'validation') as week_mean_validation, stddev_samp(w) filter (phase = 'discovery') as sd from wk group by 1),
peers as (select c.candidate_id, round(abs(j.quantile - c.quantile), 9) as d, count(*) filter (mean_discovery > 0 and mean_validation > 0) as k from cand c join judged j on j.feature_key = c.feature_key and j.tail = c.tail and j.horizon = c.horizon and j.quantile <> c.quantile group by all),
near as (select candidate_id, arg_min(k, d) as neighbours from peers group by 1), cnt as (select candidate_id, phase, count(*) as n from e group by all),
pool as (select c.candidate_id, c.direction, f.venue, f.bucket, f.phase, s.seed, row_number() over (partition by c.candidate_id, f.phase, s.seed order by md5(f.venue || '|' || strftime(f.bucket, '%Y-%m-%d %H:%M:%S') || '|' || c.candidate_id || '|' || s.seed)) as r
  from feats f join cand c using (feature_key), (values ('1'), ('2'), ('3')) s(seed) where f.phase is not null and f.value is not null),
pl as (select p.candidate_id, p.seed, avg(p.direction * o.gross - 0.002) filter (p.phase = 'discovery') as d, avg(p.direction * o.gross - 0.002) filter (p.phase = 'validation') as v from pool p join cnt on cnt.candidate_id = p.candidate_id and cnt.phase = p.phase
  join outs o on o.venue = p.venue and o.bucket = p.bucket and o.horizon = 3600 where p.r <= cnt.n group by all), pm as (select candidate_id, max(d) as placebo_discovery, max(v) as placebo_validation from pl group by 1),
alt as (select c.candidate_id, v.venue as av from cand c, (select distinct venue from outs) v qualify row_number() over (partition by c.candidate_id order by md5(c.candidate_id || '|' || v.venue), v.venue) <= 3),
mo as (select te.candidate_id, av, avg(te.direction * o.gross - 0.002) filter (te.phase = 'discovery') as d, avg(te.direction * o.gross - 0.002) filter (te.phase = 'validation') as v from te join alt on alt.candidate_id = te.candidate_id join outs o on o.venue = av and o.bucket = te.bucket and o.horizon = 3600 where te.venue <> av group by all),
mm as (select candidate_id, max(d) as other_target_discovery, max(v) as other_target_validation from mo group by 1),
g as (select *, coalesce(neighbours, 0) as nb, coalesce(weeks_discovery >= 3 and weeks_validation >= 2 and week_mean_discovery > 0 and week_mean_validation > 0 and week_mean_discovery / (sd / sqrt(weeks_discovery)) >= 1.959963984540054, false) as weekly_ok, coalesce(neighbours > 0, false) as neighbour_ok,
  coalesce(bp50_discovery > 0 and bp50_validation > 0, false) as cost_ok, coalesce(base_discovery > placebo_discovery and base_validation > placebo_validation, false) as placebo_ok, coalesce(inverse_discovery < 0 and inverse_validation < 0, false) as direction_ok
  from m join wa using (candidate_id) left join near using (candidate_id) left join pm using (candidate_id) left join mm using (candidate_id))
select candidate_id, weeks_discovery, weeks_validation, nb as neighbours, {", ".join(f"round({c}, 6) as {c}" for c in BATTERY)}, weekly_ok, neighbour_ok, cost_ok, placebo_ok, direction_ok, weekly_ok and neighbour_ok and cost_ok and placebo_ok and direction_ok as passes from g""",
)
def preholdout(spark, sf_dir):
    features, outcomes = panel(spark, sf_dir)
    tests = materialize(D.tail_screen(features, outcomes, CONFIG, ["venue", "bucket"]), "tests")
    out = D.preholdout(frozen(tests, features, CONFIG), tests, features, outcomes, "venue", "bucket", CONFIG.cost, weeks=(3, 2))
    gates = ["weekly_ok", "neighbour_ok", "cost_ok", "placebo_ok", "direction_ok", "passes"]
    return rounded(out.select("candidate_id", "weeks_discovery", "weeks_validation", "neighbours", *BATTERY, *gates), 6, *BATTERY)


SEALED = D.ScreenConfig(
    discovery=(datetime(2024, 1, 1), datetime(2024, 1, 11)), validation=(datetime(2024, 1, 11), datetime(2024, 1, 19)), quantiles=(0.05, 0.1, 0.2), cost=0.002, min_discovery=20, min_validation=10, min_hit=0.4,
)
HOLDOUT_START = "2024-01-19 00:00:00"
SEALED_SQL = PANEL_SQL.replace("timestamp '2024-01-19' then 'discovery'", "timestamp '2024-01-11' then 'discovery'").replace("timestamp '2024-01-31' then 'validation'", "timestamp '2024-01-19' then 'validation'")


def sealed_away(df: DataFrame) -> DataFrame:
    return df.where(F.col("bucket") >= F.lit(HOLDOUT_START).cast(NTZ))


@query(
    "D12_holdout_evaluation",
    f"""with {SEALED_SQL}, e as (select f.feature_key || '/' || j.tail as candidate_id, f.venue, cast(f.bucket as date) as day, direction * o.gross - 0.002 as net from judged j join cuts c using (feature_key, quantile, tail) join feats f using (feature_key)
  join outs o on o.venue = f.venue and o.bucket = f.bucket and o.horizon = 3600 where j.horizon = 3600 and quantile = 0.1 and f.bucket >= timestamp '2024-01-19' and ((j.tail = 'LOW' and f.value <= threshold) or (j.tail = 'HIGH' and f.value >= threshold))),
d as (select candidate_id, day, avg(net) as m from e group by all), w as (select candidate_id, date_trunc('week', day) as week, avg(net) as m from e group by all), v as (select candidate_id, venue, avg(net) as m from e group by all),
a as (select candidate_id, count(*) as n, avg(net) as mean, avg(net - 0.005) as mean_stressed, avg((net > 0)::int) as hit_rate, min(net) as worst, avg(net) filter (net > 0) as winner from e group by 1),
dd as (select candidate_id, count(*) as days, avg(m) as mean_days, stddev_samp(m) as sd from d group by 1), ww as (select candidate_id, count(*) as weeks, avg(m) as mean_weeks from w group by 1), vv as (select candidate_id, count(*) as entities, count(*) filter (m > 0) as positive_entities from v group by 1),
g as (select *, case when worst >= 0 then 0 else -worst / winner end as worst_loss_ratio, mean_days / (sd / sqrt(days)) as z_days from a join dd using (candidate_id) join ww using (candidate_id) join vv using (candidate_id)),
p as (select *, coalesce(n >= 30 and mean > 0 and hit_rate >= 0.4 and worst_loss_ratio <= 5, false) as panel_passes, coalesce(n >= 30 and mean > 0 and mean_stressed > 0 and days >= 10 and mean_days > 0 and weeks >= 2 and mean_weeks > 0 and z_days >= 1.2815515655446004, false) as dated_passes from g)
select candidate_id, n, round(mean, 6) as mean, round(mean_stressed, 6) as mean_stressed, round(hit_rate, 6) as hit_rate, round(worst_loss_ratio, 6) as worst_loss_ratio, entities, positive_entities, days, weeks, round(z_days, 6) as z_days, panel_passes, dated_passes, panel_passes and dated_passes as passes from p""",
)
def holdout_evaluation(spark, sf_dir):
    """Candidates are chosen on the first nineteen days; the rest is written to a guarded path and opened once."""
    features, outcomes = panel(spark, sf_dir, SEALED)
    tests = D.tail_screen(features, outcomes, SEALED, ["venue", "bucket"])
    candidates = materialize(frozen(tests, features, SEALED), "candidates")
    sealed = sealed_away(features)
    guard = D.HoldoutGuard(spark, scratch_path(spark, "holdout"))
    expected = sealed.agg(F.count("*"), F.count_distinct("venue")).first()
    guard.write(sealed, expected[0], "venue", expected[1])
    out = D.evaluate_holdout(candidates, guard.open(), outcomes, ["venue", "bucket"], F.to_date("bucket"), "venue", cost=SEALED.cost, weeks=2, min_hit=0.4, max_worst=5.0)
    names = ["mean", "mean_stressed", "hit_rate", "worst_loss_ratio", "z_days"]
    return rounded(out.select("candidate_id", "n", "mean", "mean_stressed", "hit_rate", "worst_loss_ratio", "entities", "positive_entities", "days", "weeks", "z_days", "panel_passes", "dated_passes", "passes"), 6, *names)


@query(
    "D13_holdout_gate",
    f"""with {SEALED_SQL}, k as (select *, count(*) over (partition by venue, bucket) as c from outs where bucket >= timestamp '2024-01-19')
select horizon, count(*) filter (c = 3) as rows, count(distinct venue) filter (c = 3) as entities, count(*) filter (c <> 3) as uneven, true as refused_uneven, true as refused_again from k group by 1""",
)
def holdout_gate(spark, sf_dir):
    """Outcomes of the sealed days go to a guarded path if every decision has its three horizons; opening it twice and
    writing uneven decisions are refused."""
    _, outcomes = panel(spark, sf_dir, SEALED)
    sealed = materialize(sealed_away(outcomes).withColumn("c", F.count("*").over(Window.partitionBy("venue", "bucket"))), "sealed")
    even = sealed.where("c = 3").drop("c")
    entities = even.agg(F.count_distinct("venue")).first()[0]
    guard = D.HoldoutGuard(spark, scratch_path(spark, "holdout"))
    per = {("venue", "bucket"): 3}

    def refused(f, error) -> bool:
        try:
            f()
        except error:
            return True
        return False

    whole = sealed.agg(F.count("*"), F.count_distinct("venue")).first()
    uneven = refused(lambda: guard.write(sealed.drop("c"), whole[0], "venue", whole[1], per), ValueError)
    guard.write(even, even.select("venue", "bucket").distinct().count() * 3, "venue", entities, per)
    opened = guard.open()
    again = refused(guard.open, PermissionError)
    held = opened.groupBy("horizon").agg(F.count("*").alias("rows"), F.count_distinct("venue").alias("entities"))
    left = sealed.where("c <> 3").groupBy("horizon").agg(F.count("*").alias("uneven"))
    out = held.join(left, "horizon", "full").fillna(0, ["rows", "entities", "uneven"])
    return out.select("horizon", "rows", "entities", "uneven", F.lit(uneven).alias("refused_uneven"), F.lit(again).alias("refused_again"))


@query(
    "D15_config_problems",
    f"""with {TICKS}, c as (select entity, min(ts) filter (venue = 'view') as d0, max(ts) filter (venue = 'click' and ts < timestamp '2024-01-15') as d1, min(ts) filter (venue = 'error' and ts >= timestamp '2024-01-10') as v0, max(ts) filter (venue = 'signup') as v1, list(distinct round(size / 180, 4) order by round(size / 180, 4)) filter (venue = 'purchase') as q, avg(price) / 40 as fdr from ticks group by 1)
select entity, array_to_string(list_filter([case when not coalesce(len(q) > 0 and len(list_filter(q, lambda x: not (x > 0 and x < 0.5))) = 0, false) then 'quantiles' end, case when not coalesce(d0 < d1, false) then 'discovery' end, case when not coalesce(v0 < v1, false) then 'validation' end,
  case when not coalesce(v0 >= d1, false) then 'overlap' end, case when not coalesce(fdr > 0 and fdr < 1, false) then 'fdr' end], lambda x: x is not null), ',') as problems from c""",
)
def config_problems(spark, sf_dir):
    """Run settings drawn from each entity's events."""
    t, v = ticks(spark, sf_dir), F.col("venue")
    at = lambda s: F.lit(s).cast(NTZ)
    when = lambda f, c: f(F.when(c, F.col("ts")))
    q = F.array_sort(F.collect_set(F.when(v == "purchase", F.round(F.col("size") / 180, 4))))  # of a hundred sizes
    c = t.groupBy("entity").agg(
        when(F.min, v == "view").alias("discovery_start"), when(F.max, (v == "click") & (F.col("ts") < at("2024-01-15 00:00:00"))).alias("discovery_end"), when(F.min, (v == "error") & (F.col("ts") >= at("2024-01-10 00:00:00"))).alias("validation_start"),
        when(F.max, v == "signup").alias("validation_end"), q.alias("quantiles"), (F.avg("price") / 40).alias("fdr"),
    )
    return D.config_problems(c).select("entity", F.concat_ws(",", "problems").alias("problems"))


@query("D14_materialisation_status", "select o_orderstatus as status, count(*) as partitions, count(*) filter (o_orderdate < timestamp '1998-01-01') as discovery, count(*) filter (o_orderdate >= timestamp '2001-01-01') as holdout_touched from orders group by 1")
def materialisation_status(spark, sf_dir):
    t = lambda s: F.lit(s).cast(NTZ)
    return read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("partitions"), F.count_if(F.col("o_orderdate") < t("1998-01-01 00:00:00")).alias("discovery"), F.count_if(F.col("o_orderdate") >= t("2001-01-01 00:00:00")).alias("holdout_touched")
    )


@query(
    "D16_label_permutation",
    f"""with {NET}, s as (select unnest(['1', '2', '3']) as seed), p as (select *, row_number() over (partition by kind order by id, ts, net) as r from t), d as (select kind, seed, net as dealt, row_number() over (partition by kind, seed order by md5(id || '|' || seed), id, ts, net) as r from t, s)
select brand, seed, round(avg(dealt), 6) as mean, count(*) as n from p join d using (kind, r) group by all""",
)
def label_permutation(spark, sf_dir):
    out = D.permuted(trades(spark, sf_dir).select("brand", "kind", "id", "ts", "net"), ["kind"], ["id", "ts", "net"], list(D.SEEDS), ["net"])
    return out.groupBy("brand", "seed").agg(F.round(F.avg("net"), 6).alias("mean"), F.count("*").alias("n"))


# ---- falsification -----------------------------------------------------------------------------------------------------


@query(
    "R1_shift_placebo",
    f"""with {HOURLY}, s as (select venue, bucket, close from bars where close >= 100), p as (select venue, bucket + to_hours(k) as at, k * 60 as shift from s, unnest([-2, -1, 1, 2]) as u(k))
select cast(shift as int) as shift, count(*) as n, round(avg(1 - x.close / nullif(a.close, 0)), 6) as mean from p join bars a on a.venue = p.venue and a.bucket = p.at join bars x on x.venue = p.venue and x.bucket = p.at + interval 4 hours group by 1""",
)
def shift_placebo(spark, sf_dir):
    bars = hourly(spark, sf_dir).select("venue", F.col("bucket").alias("ts"), "close")
    events = R.shifted(bars.where("close >= 100").select("venue", "ts"), [-120, -60, 60, 120])
    out = X.hedged(events, bars, ["venue"], 0, 4 * 3600, 0.0, 0.0)
    return out.groupBy("shift").agg(F.count("*").alias("n"), F.round(F.avg("gross"), 6).alias("mean"))


@query(
    "R2_matched_controls",
    f"""with {HOURLY}, s as (select venue, bucket from bars where close >= 150), c as (select b.venue, b.bucket from bars b where b.bucket in (select bucket from s) and not exists (select 1 from s where s.venue = b.venue and s.bucket = b.bucket))
select venue, bucket, row_number() over (partition by bucket order by md5(venue || '|' || strftime(bucket, '%Y-%m-%d %H:%M:%S') || '|ctl')) as rank from c qualify rank <= 2""",
)
def matched_controls(spark, sf_dir):
    bars = hourly(spark, sf_dir).select("venue", "bucket", "close")
    out = R.matched_controls(bars.where("close >= 150"), bars, "venue", "bucket", 2, "ctl")
    return out.select("venue", "bucket", F.col("rank").cast("long").alias("rank"))


@query(
    "R3_ordinary_state",
    f"""with {HOURLY}, r as (select venue, bucket, close / nullif(open, 0) - 1 as ret from bars), m as (select bucket, stddev_samp(ret) as dispersion from r where ret is not null group by 1), q as (select bucket from m where dispersion <= 0.5), s as (select venue, bucket from bars where close >= 150),
c as (select b.venue, b.bucket from bars b where b.bucket in (select bucket from q) and not exists (select 1 from s where s.venue = b.venue and s.bucket = b.bucket))
select venue, bucket from c qualify row_number() over (partition by bucket order by md5(venue || '|' || strftime(bucket, '%Y-%m-%d %H:%M:%S') || '|ord')) = 1""",
)
def ordinary_state(spark, sf_dir):
    bars = hourly(spark, sf_dir).withColumn("ret", S.change("close", "open"))
    quiet = C.market_state(bars, "bucket", "ret", entity="venue").where("dispersion <= 0.5").select("bucket")
    signals = bars.where("close >= 150").select("venue", "bucket")
    pool = bars.select("venue", "bucket").join(quiet, "bucket", "left_semi").join(signals, ["venue", "bucket"], "left_anti")
    key = F.md5(F.concat_ws("|", "venue", F.col("bucket").cast("string"), F.lit("ord")))
    return E.cap_per_entity(pool.withColumn("_h", key), ["bucket"], ["_h"], 1).select("venue", "bucket")


@query(
    "R4_ablation",
    f"""with {HOURLY}, v as (select left_out, close, case left_out when 'none' then high - low >= 30 and volume >= 100 and close <= open when 'wide' then volume >= 100 and close <= open when 'heavy' then high - low >= 30 and close <= open else high - low >= 30 and volume >= 100 end as keep
  from bars, (values ('none'), ('wide'), ('heavy'), ('down')) s(left_out)) select left_out, count(*) as n, round(avg(close), 6) as mean from v where keep group by 1""",
)
def ablation(spark, sf_dir):
    parts = {"wide": F.expr("high - low >= 30"), "heavy": F.expr("volume >= 100"), "down": F.expr("close <= open")}
    return R.ablated(hourly(spark, sf_dir), parts).groupBy("left_out").agg(F.count("*").alias("n"), F.round(F.avg("close"), 6).alias("mean"))


@query(
    "R5_concentration",
    f"""with {NET}, top as (select brand from t group by 1 order by count(*) desc, brand limit 2), l as (select b.brand, avg(net) as mean from (select distinct brand from t) b join t on t.brand <> b.brand group by 1),
w as (select avg(net) as mean, avg((net > 0)::int) as hit from t where brand not in (select brand from top)) select round(min(l.mean), 6) as worst_left_out, round(any_value(w.mean), 6) as mean_without_top, round(any_value(w.hit), 6) as hit_without_top, bool_and(l.mean > 0) and any_value(w.mean) > 0 and any_value(w.hit) > 0.5 as passes from l, w""",
)
def concentration(spark, sf_dir):
    t = trades(spark, sf_dir)
    left = M.leave_out(t, "brand").agg(F.min("mean").alias("worst_left_out"))
    rest = t.join(F.broadcast(M.top_groups(t, "brand").select("brand")), "brand", "left_anti").agg(F.avg("net").alias("mean_without_top"), F.avg((F.col("net") > 0).cast("int")).alias("hit_without_top"))
    both = left.crossJoin(rest)  # one row each
    passes = (F.col("worst_left_out") > 0) & (F.col("mean_without_top") > 0) & (F.col("hit_without_top") > 0.5)
    return rounded(both.withColumn("passes", passes), 6, "worst_left_out", "mean_without_top", "hit_without_top")


@query(
    "R6_threshold_grid",
    f"""with {HOURLY}, b as (select high - low as width, volume, close / nullif(open, 0) - 1 as ret from bars), g as (select p as parameter, f::double as factor from unnest(['width', 'volume', 'ret']) a(p), unnest([0.8, 0.9, 1.1, 1.2]) c(f))
select parameter, factor, count(*) as n from b, g where coalesce(width >= case parameter when 'width' then 30 * factor else 30 end, false) and coalesce(volume >= case parameter when 'volume' then 100 * factor else 100 end, false) and coalesce(ret <= case parameter when 'ret' then -0.1 * factor else -0.1 end, false) group by all""",
)
def threshold_grid(spark, sf_dir):
    b = hourly(spark, sf_dir).select((F.col("high") - F.col("low")).alias("width"), "volume", S.change("close", "open").alias("ret"))
    grid = R.perturbed(b, {"width": (">=", 30.0), "volume": (">=", 100.0), "ret": ("<=", -0.1)}, [0.8, 0.9, 1.1, 1.2])
    return grid.groupBy("parameter", "factor").agg(F.count("*").alias("n"))


@query(
    "R7_hold_and_weight_variants",
    f"""with {HOURLY}, h as (select bucket, avg(close) as hc from bars group by 1), o as (select cast(hold as int) as hold, 1 - x.close / nullif(e.close, 0) as own, hx.hc / nullif(he.hc, 0) - 1 as hedge from bars e, unnest([6, 10, 12]) u(hold), bars x, h he, h hx
  where x.venue = e.venue and x.bucket = e.bucket + to_hours(hold) and he.bucket = e.bucket and hx.bucket = x.bucket)
select hold, weight::double as weight, count(*) as n, round(avg(own + weight * hedge), 6) as mean from o, unnest([0.5, 0.6, 0.9]) w(weight) group by all""",
)
def hold_and_weight(spark, sf_dir):
    bars = hourly(spark, sf_dir).select("venue", F.col("bucket").alias("ts"), "close")
    hedge = bars.groupBy("ts").agg(F.avg("close").alias("hc"))
    wide = bars.withColumn("hold", F.explode(F.array(*map(F.lit, (6, 10, 12))))).withColumn("exit_ts", T.shift("ts", F.col("hold") * 3600))
    j = wide.join(bars.select("venue", F.col("ts").alias("exit_ts"), F.col("close").alias("exit_close")), ["venue", "exit_ts"]).join(hedge, "ts")
    j = j.join(hedge.select(F.col("ts").alias("exit_ts"), F.col("hc").alias("exit_hc")), "exit_ts")
    v = j.withColumn("weight", F.explode(F.array(*map(F.lit, (0.5, 0.6, 0.9)))))
    gross = -S.change("exit_close", "close") + F.col("weight") * S.change("exit_hc", "hc")
    return v.groupBy("hold", "weight").agg(F.count("*").alias("n"), F.round(F.avg(gross), 6).alias("mean"))


STUDY = f"""{HOURLY}, h as (select bucket, avg(close) as hedge_close from bars where venue <> 'signup' group by 1), v as (select venue as entity, bucket, signal_ts, n, volume, close, round(close / nullif(open, 0) - 1, 9) as value from bars where open > 0),
k as (select *, percent_rank() over (partition by bucket order by value) as rank, sum(value) over (partition by entity order by bucket rows between 2 preceding and current row) as rolled, avg(volume) over (partition by entity order by bucket rows between 6 preceding and 1 preceding) as before,
  avg(volume) over (partition by entity order by bucket rows between 5 preceding and current row) as ahead from v),
s as (select entity, bucket, case when entity = 'click' and hour(bucket) = 5 then bucket else signal_ts end as signal_ts, value, case when hour(bucket) = 3 then least(rank + 0.25, 1) else rank end as rank, rolled + case when hour(bucket) = 4 then 1 else 0 end as rolled, case when entity = 'error' then ahead else before end as liquidity
  from k where value <= -0.2 and entity <> 'signup'),
j as (select s.entity, s.bucket, s.signal_ts, case when s.entity = 'view' and hour(s.bucket) = 7 then s.signal_ts else s.bucket + interval 2 hours end as entry_ts, s.bucket + interval 5 hours as exit_ts, e.close as a, x.close as b, he.hedge_close as ha, hx.hedge_close as hb from s join v e on e.entity = s.entity and e.bucket = s.bucket + interval 2 hours
  join v x on x.entity = s.entity and x.bucket = s.bucket + interval 5 hours left join h he on he.bucket = s.bucket + interval 2 hours and he.hedge_close < 60 left join h hx on hx.bucket = s.bucket + interval 5 hours and hx.hedge_close < 60),
tr as (select *, 1 - b / nullif(a, 0) as gross, 0.0022 as cost, case when entity = 'error' then 0.002 else 0.0022 end as charged from j)"""


@query(
    "R8_integrity_checks",
    f"""with {STUDY}, m as (select v.*, (select count(*) from v o where o.bucket = v.bucket and o.value < v.value) / nullif((select count(*) from v o where o.bucket = v.bucket) - 1, 0) as r from v),
o as (select tr.*, max(exit_ts) over (partition by entity order by entry_ts, exit_ts rows between unbounded preceding and 1 preceding) as reach from tr),
c as (select 1 as number, (select count(*) from s where bucket >= timestamp '2024-01-28') as violations union all select 2, (select count(*) from s where signal_ts <> bucket + interval 1 hour) union all select 3, (select count(*) from tr where entry_ts <= signal_ts)
union all select 4, (select count(*) from s join m using (entity, bucket) where abs(s.rank - coalesce(m.r, 0)) > 1e-9) union all select 5, (select count(*) from s join k using (entity, bucket) where abs(s.rolled - k.rolled) > 1e-9) union all select 6, (select count(*) from (select distinct entity from v) where entity not in (select entity from s))
union all select 7, (select count(*) from s join k using (entity, bucket) where s.liquidity is distinct from k.before and coalesce(abs(s.liquidity - k.before) > 1e-9, true)) union all select 8, (select count(*) from tr where ha is null or hb is null) union all select 9, (select count(*) from tr where abs(cost - charged) > 1e-6)
union all select 10, (select count(*) from o where entry_ts < reach) union all select 11, (select count(*) from tr join v using (entity, bucket) where n < 2) union all select 12, (select count(*) from s where not value <= -0.25) union all select 13, (select greatest(0, 31 - count(distinct cast(bucket as date))) from v))
select number, violations from c""",
)
def integrity_checks(spark, sf_dir):
    """A study over the hourly bars in which some rows are wrong on purpose, so that checks have something to find."""
    c, hour = F.col, F.hour("bucket")
    v = hourly(spark, sf_dir).where("open > 0").select(c("venue").alias("entity"), "bucket", "signal_ts", "n", "volume", "close", F.round(S.change("close", "open"), 9).alias("value"))
    hedge = hourly(spark, sf_dir).where("venue <> 'signup'").groupBy("bucket").agg(F.avg("close").alias("hedge_close"))
    w = Window.partitionBy("entity").orderBy("bucket")
    k = v.withColumns({
        "rank": F.percent_rank().over(Window.partitionBy("bucket").orderBy("value")), "rolled": F.sum("value").over(w.rowsBetween(-2, 0)), "_before": F.avg("volume").over(w.rowsBetween(-6, -1)), "_ahead": F.avg("volume").over(w.rowsBetween(-5, 0))
    })
    s = k.where("value <= -0.2 and entity <> 'signup'").select(
        "entity", "bucket", F.when((c("entity") == "click") & (hour == 5), c("bucket")).otherwise(c("signal_ts")).alias("signal_ts"), "value", F.when(hour == 3, F.least(c("rank") + 0.25, F.lit(1.0))).otherwise(c("rank")).alias("rank"),
        (c("rolled") + F.when(hour == 4, 1).otherwise(0)).alias("rolled"), F.when(c("entity") == "error", c("_ahead")).otherwise(c("_before")).alias("liquidity"),
    )
    priced = v.select("entity", c("bucket").alias("ts"), "close")
    j = X.hedged(s.select("entity", "bucket", "signal_ts", c("bucket").alias("ts")), priced, ["entity"], 7200, 3 * 3600, 0.0, 0.0022)
    usable = hedge.where("hedge_close < 60")
    j = j.join(usable.select(c("bucket").alias("entry_ts"), c("hedge_close").alias("hedge_entry")), "entry_ts", "left").join(usable.select(c("bucket").alias("exit_ts"), c("hedge_close").alias("hedge_exit")), "exit_ts", "left")
    early = (c("entity") == "view") & (F.hour("bucket") == 7)
    t = j.withColumns({"entry_ts": F.when(early, c("signal_ts")).otherwise(c("entry_ts")), "cost": F.lit(0.0022), "net": c("gross") - F.when(c("entity") == "error", 0.002).otherwise(0.0022)})
    out = Q.integrity_checks(v, s, t, F.lit("2024-01-28 00:00:00").cast(NTZ), 3600, 2, -0.25, 31)
    return out.select("number", "violations")


GATES = f"""{NET}, x as (select *, net - 0.001 as v, case when ts < timestamp '1997-01-01' then 1 when ts < timestamp '2000-01-01' then 2 else 3 end as block from t),
bl as (select brand, count(*) as positive_blocks from (select brand, block from x group by brand, block having avg(v) > 0 and avg((v > 0)::int) > 0.5) group by brand),
sup as (select brand, supplier, count(*) as c, sum(v) as s, sum((v > 0)::int) as w, row_number() over (partition by brand order by count(*) desc, supplier) as r from x group by brand, supplier), tot as (select brand, sum(c) as c, sum(s) as s from sup group by 1),
lo as (select sup.brand, min((tot.s - sup.s) / nullif(tot.c - sup.c, 0)) as worst from sup join tot using (brand) group by 1), re as (select brand, sum(s) filter (r > 2) / nullif(sum(c) filter (r > 2), 0) as mean_rest, sum(w) filter (r > 2) / nullif(sum(c) filter (r > 2), 0) as hit_rest from sup group by 1),
a as (select brand, count(*) as n, avg((v > 0)::int) as hit_rate, avg(v) as mean, coalesce(sum(v) filter (v > 0), 0) / -sum(v) filter (v < 0) as profit_factor, avg(v - 0.0003) as mean_stressed,
  avg(v - 0.0001) > 0 and avg((v - 0.0001 > 0)::int) > 0.5 and avg(v - 0.0002) > 0 and avg((v - 0.0002 > 0)::int) > 0.5 and avg(v - 0.0003) > 0 and avg((v - 0.0003 > 0)::int) > 0.5 as stressed_ok,
  coalesce(avg(v) filter (concurrency <= 4) > 0 and avg((v > 0)::int) filter (concurrency <= 4) > 0.5, false) as executable_ok from x group by 1),
m as (select a.*, coalesce(positive_blocks, 0) as positive_blocks, coalesce(worst > 0 and mean_rest > 0 and hit_rest > 0.5, false) as concentration_ok from a left join bl using (brand) join lo using (brand) join re using (brand))"""


def graded_input(spark, sf_dir):
    t = lambda s: F.lit(s).cast(NTZ)
    block = F.when(F.col("ts") < t("1997-01-01 00:00:00"), 1).when(F.col("ts") < t("2000-01-01 00:00:00"), 2).otherwise(3)
    return R.gates(trades(spark, sf_dir), ["brand"], "supplier", block, F.col("concurrency") <= 4, [0.0001, 0.0002, 0.0003], cost=0.001)


@query(
    "R9_historical_grades",
    f"""with {GATES} select brand, positive_blocks, stressed_ok, executable_ok, concentration_ok, case when hit_rate > 0.5 and mean > 0 and n >= 30 and positive_blocks >= 2 and stressed_ok and executable_ok and concentration_ok then 'A' when hit_rate > 0.5 and mean > 0 and n < 30 then 'B' when mean <= 0 and hit_rate <= 0.5 then 'D' else 'C' end as grade from m""",
)
def historical_grades(spark, sf_dir):
    return R.grade_history(graded_input(spark, sf_dir)).select("brand", "positive_blocks", "stressed_ok", "executable_ok", "concentration_ok", "grade")


@query(
    "R9_forward_grades",
    f"""with {GATES}, q as (select p_brand as brand, count(*) filter (p_retailprice <= 0 or p_size > 49) = 0 as checks_ok from part group by 1)
select brand, checks_ok, concentration_ok, case when n < 10 then 'B' when not (hit_rate > 0.5 and mean > 0 and coalesce(profit_factor, 'inf'::double) > 1 and mean_stressed > 0) then 'D' when not (checks_ok and concentration_ok) then 'C' else 'A' end as grade from m join q using (brand)""",
)
def forward_grades(spark, sf_dir):
    """The checks of a brand are those of its parts: a price above zero and a size below fifty."""
    checks = read(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("brand")).agg((F.count_if((F.col("p_retailprice") <= 0) | (F.col("p_size") > 49)) == 0).alias("checks_ok"))
    return R.grade_forward(graded_input(spark, sf_dir).join(checks, "brand")).select("brand", "checks_ok", "concentration_ok", "grade")
