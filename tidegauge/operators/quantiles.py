"""Running totals, places and exact percentiles of groups of any size.

Rows are dealt by range of (group, order) and written; a row's total is that within its range plus the totals of the
group's ranges before it, so no task gets a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.scan import largest_group
from tidegauge.operators.scratch import materialize

#: Distinct values of a group up to which one task holds them for its percentiles.
LIMIT = 1_000_000


def running(df: DataFrame, by: list[str], order: list[str], weight: Column, name: str) -> DataFrame:
    """df with the sum of ``weight`` over the group's rows up to this one. Groups aren't null."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_w", weight).repartitionByRange(parts, *by, *order).withColumn("_p", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")
    own = Window.partitionBy(*by, "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = dealt.groupBy(*by, "_p").agg(F.sum("_w").alias("_t"))
    before = totals.withColumn("_b", F.sum("_t").over(Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)))
    # a range starts inside of one group at most, so there are no more such rows than ranges
    offsets = F.broadcast(before.where("_b is not null").drop("_t"))
    out = dealt.withColumn(name, F.sum("_w").over(own)).join(offsets, [*by, "_p"], "left")
    return out.withColumn(name, F.col(name) + F.coalesce("_b", F.lit(0))).drop("_w", "_p", "_b")


def places(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """df with the row's place in its group, from 1; rows that agree in all of ``order`` take theirs in any order."""
    return running(df, by, order, F.lit(1).cast("long"), name)


def sorted_places(df: DataFrame, by: list[str], order: list[str], keep: list[str], name: str) -> DataFrame:
    """The columns ``keep``, with ``by`` among them, and the row's place in its group, from 1, as in ``places``. Rows move once:
    they are numbered as they stand in the sorted ranges, so what orders them isn't written."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *by, *order).sortWithinPartitions(*by, *order)
    dealt = materialize(dealt.select(*keep, F.monotonically_increasing_id().alias("_i")), "sorted")
    # a number's upper bits are its range's
    placed = dealt.withColumn("_p", F.shiftright("_i", 33))
    held = placed.groupBy(*by, "_p").agg(F.min("_i").alias("_s"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = held.select(*by, "_p", (F.col("_s") - before).alias("_s"))
    return placed.join(starts, [*by, "_p"]).select(*keep, (F.col("_i") - F.col("_s") + 1).alias(name))


def value_counts(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, value and its number of rows ``_n``, written once; null values are left out."""
    return materialize(df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n")), "values")


def percentiles_of(values: DataFrame, by: list[str], value: str, points: dict[str, float], within: dict[str, Column] | None = None, limit: int = LIMIT) -> DataFrame:
    """by and the exact interpolated percentiles of each group of ``value_counts``, of the values for which ``within`` (by
    the point's name) holds where given; in one task's memory where all groups have at most ``limit`` distinct values,
    else by the values' places."""
    largest = values.groupBy(*by).agg(F.count("*").alias("_d")).agg(F.max("_d")).first()[0]
    x, n, within = F.col(value), F.col("_n"), within or {}
    if (largest or 0) <= limit:
        free = [k for k in points if k not in within]
        own = [F.percentile(F.when(within[k], x), F.lit(float(points[k])), n).alias(k) for k in within]
        if not free:
            return values.groupBy(*by).agg(*own)
        out = values.groupBy(*by).agg(F.percentile(x, F.array(*(F.lit(float(points[k])) for k in free)), n).alias("_q"), *own)
        return out.select(*by, *(F.col("_q")[free.index(k)].alias(k) if k in free else k for k in points))
    found = values.select(*by).distinct()
    for held in {tuple(k for k in points if (k in within) == side and (not side or k == one)) for side in (False, True) for one in (points if side else [""])}:
        if held:
            rows = values.where(within[held[0]]) if held[0] in within else values
            found = found.join(_placed_percentiles(rows, by, value, {k: points[k] for k in held}), by, "left")
    return found


def _placed_percentiles(values: DataFrame, by: list[str], value: str, points: dict[str, float]) -> DataFrame:
    # a value holds the places [upto - n, upto), from 0; a point lies between the places floor and ceil of (total - 1) * q
    placed = running(values, by, [value], F.col("_n"), "_upto")
    rows = placed.join(values.groupBy(*by).agg(F.sum("_n").alias("_all")), by)
    at = {k: (F.col("_all") - 1) * F.lit(float(q)) for k, q in points.items()}
    holds = lambda place: (place < F.col("_upto")) & (place >= F.col("_upto") - F.col("_n"))
    picks = [F.max(F.when(holds(end(at[k])), F.col(value))).alias(f"{k}_{name}") for k in points for name, end in (("lo", F.floor), ("hi", F.ceil))]
    met = rows.groupBy(*by, "_all").agg(*picks)
    between = lambda k: F.col(f"{k}_lo") + (F.col(f"{k}_hi") - F.col(f"{k}_lo")) * (at[k] - F.floor(at[k]))
    return met.select(*by, *(between(k).alias(k) for k in points))


def percentiles(df: DataFrame, by: list[str], value: str, points: dict[str, float], limit: int = LIMIT) -> DataFrame:
    """by and exact percentiles of the value's rows of each group; groups aren't null. A count of rows decides: where every
    group has at most ``limit`` one aggregation does, else values are counted first, and beyond that dealt by range."""
    solid = df.where(F.col(value).isNotNull())
    if largest_group(solid, by) > limit:
        return percentiles_of(value_counts(df, by, value), by, value, points, limit=limit)
    found = solid.groupBy(*by).agg(F.percentile(value, F.array(*(F.lit(float(q)) for q in points.values()))).alias("_q"))
    return found.select(*by, *(F.col("_q")[k].alias(name) for k, name in enumerate(points)))
