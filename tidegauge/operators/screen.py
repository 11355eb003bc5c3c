"""Discovery of tail effects with false-discovery control, and evaluation on an isolated holdout."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidegauge.operators.metrics import z_of
from tidegauge.operators.quantiles import percentiles, places, sorted_places
from tidegauge.operators.scratch import materialize


@dataclass(frozen=True)
class ScreenConfig:
    """Phases as [start, end), tails, cost and gates of a screen; checked when made."""

    discovery: tuple[datetime, datetime]
    validation: tuple[datetime, datetime]
    quantiles: tuple[float, ...] = (0.02, 0.05, 0.10, 0.20)
    cost: float = 0.0
    min_discovery: int = 150
    min_validation: int = 50
    min_hit: float = 0.500001
    max_worst_loss_ratio: float | None = None
    fdr: float = 0.05
    sides: tuple[int, ...] = field(default=())

    def __post_init__(self) -> None:
        if not self.quantiles or not all(0 < q < 0.5 for q in self.quantiles):
            raise ValueError("quantiles lie strictly between 0 and 0.5")
        for start, end in (self.discovery, self.validation):
            if start >= end:
                raise ValueError("a phase starts before it ends")
        if self.validation[0] < self.discovery[1]:
            raise ValueError("validation starts when discovery has ended")
        if not 0 < self.fdr < 1:
            raise ValueError("fdr lies strictly between 0 and 1")


def phase_of(ts: Column, config: ScreenConfig) -> Column:
    t = lambda x: F.lit(x.isoformat(sep=" ")).cast("timestamp_ntz")
    (d0, d1), (v0, v1) = config.discovery, config.validation
    return F.when((ts >= t(d0)) & (ts < t(d1)), "discovery").when((ts >= t(v0)) & (ts < t(v1)), "validation")


def thresholds(features: DataFrame, quantiles: tuple[float, ...], scope: list[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """Low and high thresholds per feature (and scope) from its discovery rows: quantile, tail, threshold. Exact at any size
    (by the places of the values where they don't fit a task), or with ``accuracy`` by sketches in one pass."""
    keys = ["feature_key", *(scope or [])]
    known = features.where("phase = 'discovery' and value is not null")
    if accuracy:
        wide = known.groupBy(*keys).agg(F.percentile_approx("value", [x for q in quantiles for x in (q, 1 - q)], accuracy).alias("_q"))
        at = lambda k: F.col("_q")[k]
    else:
        wide = percentiles(known, keys, "value", {f"_q{k}": x for k, x in enumerate(y for q in quantiles for y in (q, 1 - q))})
        at = lambda k: F.col(f"_q{k}")
    rows = [
        F.struct(F.lit(float(q)).alias("quantile"), F.lit(tail).alias("tail"), at(2 * i + k).alias("threshold"))
        for i, q in enumerate(quantiles)
        for k, tail in enumerate(("LOW", "HIGH"))
    ]
    return wide.select(*keys, F.explode(F.array(*rows)).alias("_r")).select(*keys, "_r.*")


def tail_events(features: DataFrame, cuts: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Feature rows in a tail, once for each tail and quantile they lie in. A feature's cuts, which are a few, reach its rows
    as one list, so rows outside of every tail are never multiplied."""
    keys = ["feature_key", *(scope or [])]
    rest = [c for c in cuts.columns if c not in keys]
    listed = cuts.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("_cuts"))
    low = lambda c: (c["tail"] == "LOW") & (F.col("value") <= c["threshold"])
    high = lambda c: (c["tail"] == "HIGH") & (F.col("value") >= c["threshold"])
    met = features.join(listed, keys).withColumn("_c", F.explode(F.filter("_cuts", lambda c: low(c) | high(c))))
    return met.select(*features.columns, "_c.*")


TEST = ["feature_key", "quantile", "tail", "horizon"]


def other_entities(events: DataFrame, outcomes: DataFrame, entity: str, ts: str) -> DataFrame:
    """Events with the outcomes of all other entities at their time, an equi-join on the time: of (events at a time) x
    (entities) rows, which a panel of bounded width keeps in proportion to the events."""
    others = outcomes.withColumnRenamed(entity, "target")
    return events.join(others, ts).where(F.col(entity) != F.col("target"))


#: Sums of a set of outcomes from which the metrics of the returns in either direction follow; ``up`` and ``down`` are those in
#: which a position of that direction wins after cost.
_SUMS = ("rows", "n", "s", "q", "up_n", "up_s", "down_n", "down_s")


def peer_sums(events: DataFrame, outcomes: DataFrame, entity: str, ts: str, cost: float) -> DataFrame:
    """Events with the sums over the outcomes of all other entities at their time, once for each horizon: those of the whole
    cross-section less the entity's own. Nothing is listed by pairs, so the rows are events times horizons whatever the
    width of the panel. ``least`` and ``most`` are taken from the two extremes of different entities. Events without an
    outcome of another entity are left out."""
    x = F.col("gross")
    net = {"up": x - F.lit(cost), "down": -x - F.lit(cost)}
    won = {k: F.count_if(v > 0).alias(f"{k}_n") for k, v in net.items()} | {f"{k}s": F.coalesce(F.sum(F.when(v > 0, v)), F.lit(0.0)).alias(f"{k}_s") for k, v in net.items()}
    own = outcomes.groupBy(entity, ts, "horizon").agg(
        F.count("*").alias("rows"), F.count(x).alias("n"), F.coalesce(F.sum(x), F.lit(0.0)).alias("s"), F.coalesce(F.sum(x * x), F.lit(0.0)).alias("q"), *won.values(), F.min(x).alias("least"), F.max(x).alias("most"),
    )
    own = materialize(own, "peers")
    ends = own.groupBy(ts, "horizon").agg(*(F.sum(c).alias(f"_{c}") for c in _SUMS), F.min(F.struct("least", entity)).alias("_low"), F.max(F.struct("most", entity)).alias("_high"))
    # the extremes of the entities other than the one that has them
    second = own.where("n > 0").join(own.where("n > 0").groupBy(ts, "horizon").agg(F.min(F.struct("least", entity)).alias("_low"), F.max(F.struct("most", entity)).alias("_high")), [ts, "horizon"])
    apart = lambda end: F.col(entity) != F.col(f"{end}.{entity}")
    second = second.groupBy(ts, "horizon").agg(F.min(F.struct("least", entity)).alias("_low"), F.max(F.struct("most", entity)).alias("_high"), F.min(F.when(apart("_low"), F.col("least"))).alias("_low2"), F.max(F.when(apart("_high"), F.col("most"))).alias("_high2"))
    whole = ends.drop("_low", "_high").join(second, [ts, "horizon"], "left")
    mine = own.select(F.col(entity).alias("_e"), F.col(ts).alias("_t"), F.col("horizon").alias("_h"), *(F.col(c).alias(f"o_{c}") for c in _SUMS))
    met = events.join(whole, ts).join(mine, (F.col(entity) == F.col("_e")) & (F.col(ts) == F.col("_t")) & (F.col("horizon") == F.col("_h")), "left")
    sums = [(F.col(f"_{c}") - F.coalesce(f"o_{c}", F.lit(0))).alias(c) for c in _SUMS]
    other = lambda end, two: F.when(F.col(f"{end}.{entity}") == F.col(entity), F.col(two)).otherwise(F.col(f"{end}.{'least' if end == '_low' else 'most'}"))
    return met.select(*events.columns, "horizon", *sums, other("_low", "_low2").alias("least"), other("_high", "_high2").alias("most")).where("rows > 0")


def peers_scored(events: DataFrame, config: ScreenConfig) -> DataFrame:
    """``peer_sums`` with the direction learned on discovery, and of the net returns in it n, the sum ``net``, the sum of
    squares, wins, their sum and the worst."""
    direction = events.where("phase = 'discovery'").groupBy(*TEST).agg((F.sum("s") / F.sum("n")).alias("_m"), F.sum("rows").alias("_n"))
    direction = direction.where(F.col("_n") >= config.min_discovery).select(*TEST, F.signum("_m").cast("int").alias("direction"))
    d, cost, n = F.col("direction"), F.lit(config.cost), F.col("n")
    pick = lambda up, down, none: F.when(d > 0, up).when(d < 0, down).otherwise(none)
    zero = F.lit(0.0)
    return events.join(direction, TEST).withColumns({
        "net": d * F.col("s") - cost * n, "squares": d * d * F.col("q") - 2 * cost * d * F.col("s") + cost * cost * n, "wins": pick(F.col("up_n"), F.col("down_n"), F.lit(0 if config.cost >= 0 else 1) * n),
        "gain": pick(F.col("up_s"), F.col("down_s"), zero if config.cost >= 0 else -cost * n), "worst": pick(F.col("least") - cost, -F.col("most") - cost, -cost),
    })


def peer_screen(features: DataFrame, outcomes: DataFrame, config: ScreenConfig, entity: str, ts: str) -> DataFrame:
    """``tail_screen`` of tail events against the outcomes of all other entities at their time, from sums."""
    events = tail_events(features, thresholds(features, config.quantiles))
    net = peers_scored(peer_sums(events, outcomes, entity, ts, config.cost), config)
    by_phase = {}
    for phase in ("discovery", "validation"):
        own = lambda c: F.when(F.col("phase") == phase, F.col(c))  # noqa: B023, E731
        n, s = F.sum(own("n")), F.sum(own("net"))
        spread = F.greatest(F.sum(own("squares")) - s * s / n, F.lit(0.0))
        by_phase |= {
            f"n_{phase}": F.coalesce(n, F.lit(0)), f"mean_{phase}": F.try_divide(s, n), f"hit_{phase}": F.try_divide(F.sum(own("wins")), n), f"worst_{phase}": F.min(F.when(F.col("n") > 0, own("worst"))),
            f"winner_{phase}": F.try_divide(F.sum(own("gain")), F.sum(own("wins"))), f"sd_{phase}": F.when(n > 1, F.sqrt(spread / (n - 1))),
        }
    tests = net.groupBy(*TEST, "direction").agg(*(c.alias(k) for k, c in by_phase.items()))
    return judged(tests.withColumn("z", z_of("mean_validation", "sd_validation", "n_validation")), config)


def peer_cluster_means(events: DataFrame, by: list[str], cluster: list[str]) -> DataFrame:
    """Mean, sample deviation, number and z of the means of clusters of ``peers_scored`` events."""
    means = events.groupBy(*by, *cluster).agg(F.sum("n").alias("_n"), F.sum("net").alias("_s")).where("_n > 0").withColumn("_m", F.col("_s") / F.col("_n"))
    out = means.groupBy(*by).agg(F.avg("_m").alias("mean"), F.stddev_samp("_m").alias("sd"), F.count("*").alias("clusters"))
    return out.withColumn("z", z_of("mean", "sd", "clusters"))


def scored(events: DataFrame, config: ScreenConfig) -> DataFrame:
    """Events with the direction learned on discovery and the net return in it."""
    direction = events.where("phase = 'discovery'").groupBy(*TEST).agg(F.avg("gross").alias("_m"), F.count("*").alias("_n"))
    direction = direction.where(F.col("_n") >= config.min_discovery).select(*TEST, F.signum("_m").cast("int").alias("direction"))
    return events.join(direction, TEST).withColumn("net", F.col("direction") * F.col("gross") - F.lit(config.cost))


def tail_screen(features: DataFrame, outcomes: DataFrame, config: ScreenConfig, join: list[str], cluster: list[str] | None = None, events: DataFrame | None = None) -> DataFrame:
    """One row per test (feature, quantile, tail, horizon): the direction learned on discovery, both phases' metrics,
    z and p of the validation mean (of clusters where given), and whether validation passes.

    All features are screened in one job: thresholds, events, outcomes by equi-join on ``join``, one aggregation.
    features: feature_key, value, phase and the join keys; outcomes: the join keys, horizon, gross. ``events`` replaces
    the join of tail events and outcomes.
    """
    if events is None:
        events = tail_events(features, thresholds(features, config.quantiles)).join(outcomes, join)
    net = scored(events, config)
    x, by_phase = F.col("net"), {}
    for phase in ("discovery", "validation"):
        own = F.when(F.col("phase") == phase, x)
        by_phase |= {
            f"n_{phase}": F.count(own),
            f"mean_{phase}": F.avg(own),
            f"hit_{phase}": F.avg((own > 0).cast("double")),
            f"worst_{phase}": F.min(own),
            f"winner_{phase}": F.avg(F.when(own > 0, own)),
            f"sd_{phase}": F.stddev_samp(own),
        }
    tests = net.groupBy(*TEST, "direction").agg(*(c.alias(k) for k, c in by_phase.items()))
    if cluster:
        means = net.where("phase = 'validation'").groupBy(*TEST, *cluster).agg(F.avg("net").alias("_m"))
        inference = means.groupBy(*TEST).agg(F.avg("_m").alias("_mean"), F.stddev_samp("_m").alias("_sd"), F.count("*").alias("clusters"))
        tests = tests.join(inference, TEST, "left").withColumn("z", z_of("_mean", "_sd", "clusters")).drop("_mean", "_sd")
    else:
        tests = tests.withColumn("z", z_of("mean_validation", "sd_validation", "n_validation"))
    return judged(tests, config)


def judged(tests: DataFrame, config: ScreenConfig) -> DataFrame:
    """Tests with both phases' metrics and z, and whether validation passes."""
    ratio = F.when(F.col("worst_validation") >= 0, 0.0).otherwise(F.try_divide(-F.col("worst_validation"), F.col("winner_validation")))
    passes = (F.col("mean_validation") > 0) & (F.col("n_validation") >= config.min_validation) & (F.col("hit_validation") >= config.min_hit)
    if config.max_worst_loss_ratio is not None:
        passes = passes & (ratio <= config.max_worst_loss_ratio)
    return tests.withColumns({"worst_loss_ratio": ratio, "passes": F.coalesce(passes, F.lit(False)), "p": one_sided_p("z")})


@F.pandas_udf(DoubleType())
def _half_erfc(z: pd.Series) -> pd.Series:
    from math import erfc, sqrt

    return pd.Series([None if v is None or np.isnan(v) else min(1.0, max(0.0, 0.5 * erfc(v / sqrt(2)))) for v in z], dtype="float64")


def one_sided_p(z: str | Column) -> Column:
    """Chance of at least z under a standard normal; null for null. Neither SQL nor Spark has erfc."""
    return _half_erfc(F.col(z) if isinstance(z, str) else z)


def two_sided_p(z: str | Column) -> Column:
    c = F.col(z) if isinstance(z, str) else z
    return F.least(F.lit(1.0), 2 * _half_erfc(F.abs(c)))


def bh_qvalues(tests: DataFrame, p: str = "p", family: list[str] | None = None, tie: list[str] | None = None) -> DataFrame:
    """Benjamini-Hochberg q-values within each family: the running minimum, from the worst rank, of p * m / rank.

    A family is one window partition: it holds tests, not data. Tests without p get no q.
    """
    keys, order = family or [F.lit(0)], [p, *(tie or TEST)]
    solid = F.col(p).isNotNull()
    part = Window.partitionBy(*keys, solid)
    rank = F.row_number().over(part.orderBy(*order))
    ranked = tests.withColumns({"_rank": rank, "_m": F.count("*").over(part)})
    raw = F.least(F.lit(1.0), F.col(p) * F.col("_m") / F.col("_rank"))
    q = F.min(F.when(solid, raw)).over(part.orderBy("_rank").rowsBetween(0, Window.unboundedFollowing))
    return ranked.withColumn("q", q).drop("_rank", "_m")


def neighbours(tests: DataFrame, mean: str = "mean_validation", by: tuple[str, ...] = ("feature_key", "quantile", "tail"), over: str = "horizon") -> DataFrame:
    """Whether a neighbouring horizon of the same test has a mean above zero too; without neighbours it counts as so."""
    w = Window.partitionBy(*by).orderBy(over)
    before, after = F.lag(mean).over(w), F.lead(mean).over(w)
    alone = before.isNull() & after.isNull()
    return tests.withColumn("neighbour_ok", alone | F.coalesce(before > 0, F.lit(False)) | F.coalesce(after > 0, F.lit(False)))


def freeze(tests: DataFrame, fdr: float, prefix: str = "C", key: list[str] | None = None) -> DataFrame:
    """Candidates: tests with q <= fdr, a positive mean, a pass and a supporting neighbour, with an id that follows from
    the definition and a tier (strong from q <= fdr / 10)."""
    columns = key or TEST
    definition = F.concat_ws("|", *(F.col(c).cast("string") for c in columns), F.col("direction").cast("string"))
    kept = tests.where((F.col("q") <= fdr) & (F.col("mean_validation") > 0) & F.col("passes") & F.col("neighbour_ok"))
    return kept.withColumns(
        {
            "candidate_id": F.concat(F.lit(f"{prefix}-"), F.upper(F.substring(F.md5(definition), 1, 12))),
            "definition_hash": F.sha2(definition, 256),
            "tier": F.when(F.col("q") <= fdr / 10, "strong").otherwise("supported"),
        }
    )


def dependence_review(events: DataFrame, by: list[str], cluster: str, value: str, min_clusters: int = 8, alpha: float = 0.05) -> DataFrame:
    """Means of clusters, their one-sided p, and whether there are enough clusters and p is small."""
    from tidegauge.operators.metrics import cluster_means

    out = cluster_means(events, by, [cluster], value)
    p = one_sided_p("z")
    return out.withColumn("p", p).withColumn("passes", (F.col("clusters") >= min_clusters) & F.coalesce(F.col("p") <= alpha, F.lit(False)))


def permuted(df: DataFrame, within: list[str], ties: list[str], seeds: list[str], columns: list[str]) -> DataFrame:
    """Rows once for each seed with the named columns dealt anew within their group, by order of a digest of (the first of
    ties, seed). The ties order all rows that differ. Both orders are places by range, so no task gets a whole group."""
    own = sorted_places(df, within, ties, [c for c in df.columns if c not in columns], "_r")
    seed = F.explode(F.array(*map(F.lit, seeds))).alias("seed")
    held = [f"_d_{c}" for c in columns]
    keyed = df.select(*within, *ties, *(F.col(c).alias(d) for c, d in zip(columns, held, strict=True)), seed)
    keyed = keyed.withColumn("_key", F.unhex(F.md5(F.concat_ws("|", F.col(ties[0]).cast("string"), "seed"))))
    dealt = sorted_places(keyed, [*within, "seed"], ["_key", *ties], [*within, "seed", *held], "_r")
    out = own.join(dealt, [*within, "_r"])
    return out.select(*(F.col(f"_d_{c}").alias(c) if c in columns else c for c in df.columns), "seed")


SEEDS = ("1", "2", "3")


def preholdout(
    candidates: DataFrame, tests: DataFrame, features: DataFrame, outcomes: DataFrame, entity: str, ts: str, cost: float, weeks: tuple[int, int] = (12, 6), seeds: tuple[str, ...] = SEEDS, alternates: int = 3
) -> DataFrame:
    """The battery before a holdout, one row per candidate, all candidates in one pass: means by weeks, means under 50 and
    100 basis points, the direction turned round, the neighbouring quantile, times drawn anew and other targets.

    candidates: candidate_id, feature_key, quantile, tail, threshold, horizon, direction. tests: the screen's, of all
    quantiles. A candidate passes with enough weeks and positive weekly means in both phases and a two-sided p of at most
    0.05 in discovery, a nearest quantile that is positive in both, a mean in both phases above that of every seed's
    drawn times, positive means under 50 basis points and negative ones of the inverse. Other targets are diagnostic.
    """
    frozen = candidates.select("candidate_id", "feature_key", "tail", "threshold", "horizon", "direction")
    events = tail_events(features.where("phase is not null"), frozen)
    net = events.join(outcomes, [entity, ts, "horizon"]).withColumn("directed", F.col("direction") * F.col("gross"))
    phases, x = ("discovery", "validation"), F.col("directed")
    own = lambda p, c: F.avg(F.when(F.col("phase") == p, c))
    means = {f"{name}_{p}": own(p, c) for p in phases for name, c in (("base", x - cost), ("bp50", x - 0.005), ("bp100", x - 0.01), ("inverse", -x - cost))}
    out = net.groupBy("candidate_id").agg(*(c.alias(k) for k, c in means.items()))
    weekly = net.groupBy("candidate_id", "phase", F.trunc(F.to_date(ts), "week").alias("_week")).agg(F.avg(x - cost).alias("_m")).groupBy("candidate_id")
    facts = {f"{name}_{p}": f(F.when(F.col("phase") == p, F.col("_m"))) for p in phases for name, f in (("weeks", F.count), ("week_mean", F.avg), ("_sd", F.stddev_samp))}
    out = out.join(weekly.agg(*(c.alias(k) for k, c in facts.items())), "candidate_id").withColumn("week_z", z_of("week_mean_discovery", "_sd_discovery", "weeks_discovery"))
    # the nearest quantiles of the same test
    mine = candidates.select("candidate_id", "feature_key", "tail", "horizon", F.col("quantile").alias("_own"))
    peers = mine.join(tests, ["feature_key", "tail", "horizon"]).where("quantile <> _own").withColumn("_d", F.round(F.abs(F.col("quantile") - F.col("_own")), 9))
    both = (F.col("mean_discovery") > 0) & (F.col("mean_validation") > 0)
    near = peers.groupBy("candidate_id", "_d").agg(F.count_if(both).alias("_k")).groupBy("candidate_id").agg(F.min_by("_k", "_d").alias("neighbours"))
    # as many times of the phase as there are events, drawn by digest
    counts = net.groupBy("candidate_id", "phase").agg(F.count("*").alias("_n"))
    pool = features.where("phase is not null and value is not null").select("feature_key", entity, ts, "phase").join(candidates.select("candidate_id", "feature_key"), "feature_key")
    drawn = pool.select("*", F.explode(F.array(*map(F.lit, seeds))).alias("seed")).withColumn("_key", F.md5(F.concat_ws("|", F.col(entity).cast("string"), F.col(ts).cast("string"), "candidate_id", "seed")))
    drawn = places(drawn.drop("feature_key"), ["candidate_id", "phase", "seed"], ["_key"], "_r").join(counts, ["candidate_id", "phase"]).where(F.col("_r") <= F.col("_n"))
    placebo = drawn.join(frozen.select("candidate_id", "horizon", "direction"), "candidate_id").join(outcomes, [entity, ts, "horizon"])
    placebo = placebo.groupBy("candidate_id", "seed").agg(*(own(p, F.col("direction") * F.col("gross") - cost).alias(f"_{p}") for p in phases))
    placebo = placebo.groupBy("candidate_id").agg(*(F.max(f"_{p}").alias(f"placebo_{p}") for p in phases))
    # a few other entities for each candidate: a table of candidates x entities
    others = outcomes.select(F.col(entity).alias("_alt")).distinct().crossJoin(candidates.select("candidate_id"))
    rank = F.row_number().over(Window.partitionBy("candidate_id").orderBy(F.md5(F.concat_ws("|", "candidate_id", F.col("_alt").cast("string"))), "_alt"))
    chosen = others.withColumn("_k", rank).where(F.col("_k") <= alternates).select("candidate_id", "_alt")
    moved = events.select("candidate_id", entity, ts, "horizon", "direction", "phase").join(chosen, "candidate_id").where(F.col(entity) != F.col("_alt"))
    moved = moved.join(outcomes.select(F.col(entity).alias("_alt"), ts, "horizon", "gross"), ["_alt", ts, "horizon"])
    moved = moved.groupBy("candidate_id", "_alt").agg(*(own(p, F.col("direction") * F.col("gross") - cost).alias(f"_{p}") for p in phases))
    moved = moved.groupBy("candidate_id").agg(*(F.max(f"_{p}").alias(f"other_target_{p}") for p in phases))
    for t in (near, placebo, moved):
        out = out.join(t, "candidate_id", "left")
    every = lambda *cs: F.coalesce(F.least(*(c.cast("int") for c in cs)) == 1, F.lit(False))
    c = F.col
    return out.withColumns({
        "neighbours": F.coalesce("neighbours", F.lit(0).cast("long")),
        # p <= 0.05 on both sides is z >= 1.959963984540054
        "weekly_ok": every(c("weeks_discovery") >= weeks[0], c("weeks_validation") >= weeks[1], c("week_mean_discovery") > 0, c("week_mean_validation") > 0) & F.coalesce(c("week_z") >= 1.959963984540054, F.lit(False)),
        "neighbour_ok": F.coalesce(c("neighbours") > 0, F.lit(False)),
        "cost_ok": F.coalesce((c("bp50_discovery") > 0) & (c("bp50_validation") > 0), F.lit(False)),
        "placebo_ok": F.coalesce((c("base_discovery") > c("placebo_discovery")) & (c("base_validation") > c("placebo_validation")), F.lit(False)),
        "direction_ok": F.coalesce((c("inverse_discovery") < 0) & (c("inverse_validation") < 0), F.lit(False)),
    }).withColumn("passes", c("weekly_ok") & c("neighbour_ok") & c("cost_ok") & c("placebo_ok") & c("direction_ok")).drop("_sd_discovery", "_sd_validation")


def evaluate_holdout(
    candidates: DataFrame, features: DataFrame, outcomes: DataFrame, join: list[str], day: Column, entity: str, cost: float = 0.0, extra_cost: float = 0.005, least: int = 30, days: int = 10, weeks: int = 3,
    min_hit: float = 0.5, max_worst: float | None = None,
) -> DataFrame:
    """Each frozen candidate's holdout metrics and gates, all candidates in one pass. candidates: candidate_id, feature_key,
    tail, threshold, horizon, direction.

    panel_passes: enough events, a net mean above zero, enough won, and a worst loss of at most ``max_worst`` average
    winners (if given), over all entities; positive_entities counts those with a net mean above zero. dated_passes:
    enough events, days and weeks, positive means, also under ``extra_cost``, by days and by weeks, and a one-sided p of
    the daily means of at most 0.10. passes: both.
    """
    frozen = candidates.select("candidate_id", "feature_key", "tail", "threshold", "horizon", "direction")
    events = tail_events(features, frozen).join(outcomes, [*join, "horizon"]).withColumn("net", F.col("direction") * F.col("gross") - cost)
    x = F.col("net")
    dated = events.withColumns({"_day": day, "_week": F.trunc(day, "week")})
    totals = dated.groupBy("candidate_id").agg(
        F.count("*").alias("n"), F.avg(x).alias("mean"), F.avg(x - extra_cost).alias("mean_stressed"), F.avg((x > 0).cast("double")).alias("hit_rate"), F.min(x).alias("worst"), F.avg(F.when(x > 0, x)).alias("avg_winner")
    )
    per_entity = dated.groupBy("candidate_id", entity).agg(F.avg(x).alias("_m")).groupBy("candidate_id").agg(F.count("*").alias("entities"), F.count_if(F.col("_m") > 0).alias("positive_entities"))
    totals = totals.join(per_entity, "candidate_id")
    for unit, name in (("_day", "days"), ("_week", "weeks")):
        means = dated.groupBy("candidate_id", unit).agg(F.avg("net").alias("_m"))
        agg = means.groupBy("candidate_id").agg(F.count("*").alias(name), F.avg("_m").alias(f"mean_{name}"), F.stddev_samp("_m").alias(f"_sd_{name}"))
        totals = totals.join(agg, "candidate_id").withColumn(f"z_{name}", z_of(f"mean_{name}", f"_sd_{name}", name)).drop(f"_sd_{name}")
    ratio = F.when(F.col("worst") >= 0, 0.0).otherwise(F.try_divide(-F.col("worst"), "avg_winner"))
    panel = (F.col("n") >= least) & (F.col("mean") > 0) & (F.col("hit_rate") >= min_hit)
    if max_worst is not None:
        panel = panel & (ratio <= max_worst)
    # one-sided p <= 0.10 is z >= 1.2815515655446004
    typed = (F.col("n") >= least) & (F.col("mean") > 0) & (F.col("mean_stressed") > 0) & (F.col("days") >= days) & (F.col("mean_days") > 0) & (F.col("weeks") >= weeks) & (F.col("mean_weeks") > 0) & (F.col("z_days") >= 1.2815515655446004)
    out = totals.withColumns({"worst_loss_ratio": ratio, "panel_passes": F.coalesce(panel, F.lit(False)), "dated_passes": F.coalesce(typed, F.lit(False))})
    return out.withColumn("passes", F.col("panel_passes") & F.col("dated_passes"))


def config_problems(configs: DataFrame) -> DataFrame:
    """configs (quantiles array, discovery_start, discovery_end, validation_start, validation_end, fdr and any others) with
    the array ``problems`` of what a ScreenConfig would refuse, so that a ledger of runs is checked before any runs."""
    c = F.col
    rules = {
        "quantiles": (F.size("quantiles") > 0) & F.forall("quantiles", lambda q: (q > 0) & (q < 0.5)),
        "discovery": c("discovery_start") < c("discovery_end"),
        "validation": c("validation_start") < c("validation_end"),
        "overlap": c("validation_start") >= c("discovery_end"),
        "fdr": (c("fdr") > 0) & (c("fdr") < 1),
    }
    return configs.withColumn("problems", F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()))))


class HoldoutGuard:
    """A holdout at a path of its own that is opened once: the first opening leaves a marker, the next one is refused."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _marker(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_OPENED")
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def write(self, df: DataFrame, expected_rows: int, entity: str, expected_entities: int, per_decision: dict[tuple[str, ...], int] | None = None) -> None:
        """Write df if its rows, entities and rows per decision are as expected; nothing is written otherwise."""
        got = df.agg(F.count("*"), F.count_distinct(entity)).first()
        if tuple(got) != (expected_rows, expected_entities):
            raise ValueError(f"expected {expected_rows} rows of {expected_entities} entities, got {got[0]} of {got[1]}")
        for key, n in (per_decision or {}).items():
            if not df.groupBy(*key).count().where(F.col("count") != n).isEmpty():
                raise ValueError(f"not every {key} has {n} rows")
        df.write.mode("errorifexists").parquet(f"{self.path}/data")

    def open(self) -> DataFrame:
        fs, marker = self._marker()
        if not fs.createNewFile(marker):
            raise PermissionError("the holdout has been opened before")
        return self.spark.read.parquet(f"{self.path}/data")
