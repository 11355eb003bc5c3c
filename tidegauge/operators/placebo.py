"""Placebos, ablations, perturbations and grading of event studies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.scalars import ratio
from tidegauge.functions.time import shift
from tidegauge.operators.metrics import concentration


def shifted(events: DataFrame, minutes: list[int], ts: str = "ts") -> DataFrame:
    """Every event at each shifted time, with the shift."""
    return events.withColumn("shift", F.explode(F.array(*map(F.lit, minutes)))).withColumn(ts, shift(ts, F.col("shift") * 60))


def matched_controls(signals: DataFrame, eligible: DataFrame, entity: str, ts: str, n: int, seed: str) -> DataFrame:
    """At each signal time the first n eligible entities, in order of a digest, that have no signal then."""
    times = signals.select(ts).distinct()
    peers = eligible.select(entity, ts).join(times, ts, "left_semi").join(signals.select(entity, ts), [entity, ts], "left_anti")
    key = F.md5(F.concat_ws("|", F.col(entity).cast("string"), F.col(ts).cast("string"), F.lit(seed)))
    return peers.withColumn("rank", F.row_number().over(Window.partitionBy(ts).orderBy(key))).where(F.col("rank") <= n)


def ablated(df: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """Rows once for each variant they pass: all conditions, and all but each. One scan serves every variant."""
    names = ["none", *parts]
    passed = []
    for left_out in names:
        keep = F.lit(True)
        for name, c in parts.items():
            if name != left_out:
                keep = keep & F.coalesce(c, F.lit(False))
        passed.append(F.when(keep, F.lit(left_out)))
    return df.withColumn("left_out", F.explode(F.array_compact(F.array(*passed))))


def perturbed(df: DataFrame, limits: dict[str, tuple[str, float]], factors: list[float]) -> DataFrame:
    """Rows once for each variant (parameter, factor) they pass on one shared scan; ``limits`` has a column's direction
    ("<=" or ">=") and limit, of which one at a time is multiplied. A null leg counts as not passed."""
    tests = []
    for parameter in limits:
        for factor in factors:
            keep = F.lit(True)
            for column, (sign, limit) in limits.items():
                bound = F.lit(limit * (factor if column == parameter else 1.0))
                leg = F.col(column) <= bound if sign == "<=" else F.col(column) >= bound
                keep = keep & F.coalesce(leg, F.lit(False))
            tests.append(F.when(keep, F.struct(F.lit(parameter).alias("parameter"), F.lit(factor).alias("factor"))))
    return df.withColumn("_v", F.explode(F.array_compact(F.array(*tests)))).select("*", "_v.*").drop("_v")


def gates(trades: DataFrame, by: list[str], group: str, block: Column, executable: Column, costs: list[float], gross: str = "net", cost: float = 0.0) -> DataFrame:
    """What the grades ask of each group of trades: n, hit_rate, mean and profit_factor after ``cost``, positive_blocks
    (chronological blocks with a mean above zero and over half won), stressed_ok (so under every further cost),
    mean_stressed (under the largest), executable_ok (so of the executable ones, of which there is one at least),
    concentration_ok. Costs are fractions."""
    x = F.col(gross) - cost
    good = lambda v: (F.avg(v) > 0) & (F.avg((v > 0).cast("double")) > 0.5)
    own = F.when(executable, x)
    gain, loss = F.sum(F.when(x > 0, x)), -F.sum(F.when(x < 0, x))
    stressed = good(x - costs[0])
    for c in costs[1:]:
        stressed = stressed & good(x - c)
    whole = trades.groupBy(*by).agg(
        F.count(x).alias("n"), F.avg((x > 0).cast("double")).alias("hit_rate"), F.avg(x).alias("mean"), ratio(F.coalesce(gain, F.lit(0.0)), loss).alias("profit_factor"),
        stressed.alias("stressed_ok"), F.avg(x - max(costs)).alias("mean_stressed"), F.coalesce(good(own), F.lit(False)).alias("executable_ok"), F.count(own).alias("n_executable"),
    )
    blocks = trades.groupBy(*by, block.alias("_block")).agg(good(x).alias("_good")).groupBy(*by).agg(F.count_if("_good").alias("positive_blocks"))
    return whole.join(blocks, by).join(concentration(trades.withColumn("_net", x), by, group, "_net"), by)


def grade_history(m: DataFrame) -> DataFrame:
    """A, B, C or D from the gates: all of them A; too few trades B; neither a mean above zero nor half won D; else C."""
    core = (F.col("hit_rate") > 0.5) & (F.col("mean") > 0)
    strong = (F.col("positive_blocks") >= 2) & F.col("stressed_ok") & F.col("executable_ok") & F.col("concentration_ok")
    return m.withColumn(
        "grade",
        F.when(core & (F.col("n") >= 30) & strong, "A").when(core & (F.col("n") < 30), "B").when((F.col("mean") <= 0) & (F.col("hit_rate") <= 0.5), "D").otherwise("C"),
    )


def grade_forward(m: DataFrame, least: int = 10) -> DataFrame:
    """The rule frozen beforehand: fewer than ``least`` trades B; an economic failure, that of the stressed mean included, D;
    failed checks (``checks_ok``) or concentration C; else A."""
    economic = (F.col("hit_rate") > 0.5) & (F.col("mean") > 0) & (F.coalesce("profit_factor", F.lit(float("inf"))) > 1) & (F.col("mean_stressed") > 0)
    sound = F.col("checks_ok") & F.col("concentration_ok")
    return m.withColumn("grade", F.when(F.col("n") < least, "B").when(~economic, "D").when(~sound, "C").otherwise("A"))
