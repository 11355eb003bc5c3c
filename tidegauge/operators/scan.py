"""Running values of groups of any size: a group's rows are dealt by range of (group, order) over many tasks.

Each range is written with its number. A scan then takes three steps: every range reduces the rows of a group to one
value, the few values of a group that lies in several ranges are scanned in the order of the ranges, and every range is
read once more by itself, with what the ranges before it hand on. No task gets more than one range, whatever a group's
share of the rows is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.scratch import materialize

#: Rows of a group from which on it is dealt by range; below, one sorted window of one task does.
LARGE = 2_000_000


def largest_group(df: DataFrame, by: list[str]) -> int:
    """Rows of the largest group: one aggregation over the keys alone."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def _ordered(order: list[str], backward: bool) -> list[Column]:
    return [F.desc(c) if backward else F.asc(c) for c in order]


def dealt(df: DataFrame, by: list[str], order: list[str], backward: bool = False) -> DataFrame:
    """df written in ranges of (group, order), with the range's number ``_p``; rows that agree in all of it share one."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(parts, *by, *_ordered(order, backward))
    return materialize(ranges.withColumn("_p", F.spark_partition_id()), "ranges")


def scanned(ranges: DataFrame, by: list[str], order: list[str], value: Column, name: str, how: str, backward: bool = False, before: bool = False, peers: bool = False) -> DataFrame:
    """``dealt`` ranges with ``name``, the running ``how`` (last, sum or max) of the value over the group's rows.

    Null values are passed over; while there is none but nulls the result is null. The rows run up to this one, with
    ``before`` up to the one before, with ``peers`` up to the last that agrees with this one in the order. ``backward``
    runs from the last row to the first, and has to be what the ranges were dealt by.
    """
    parts = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = {"last": lambda c: F.last(c, ignorenulls=True), "sum": F.sum, "max": F.max}[how]
    own = ranges.withColumn("_v", value)
    w = Window.partitionBy(*by, "_p").orderBy(*_ordered(order, backward))
    w = w.rangeBetween(Window.unboundedPreceding, 0) if peers else w.rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    # a range is one task's, so that its window needs no exchange by key
    placed = own.repartitionById(parts, F.col("_p")).withColumn("_o", whole("_v").over(w))
    at = F.when(F.col("_v").isNotNull(), F.struct(*order))
    total = (F.min_by("_v", at) if backward else F.max_by("_v", at)) if how == "last" else whole("_v")
    joints = own.groupBy(*by, "_p").agg(total.alias("_t"))
    earlier = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # a range begins inside of one group at most, so there are no more such rows than ranges
    handed = joints.withColumn("_b", whole("_t").over(earlier)).where("_b is not null")
    handed = handed.select(F.col("_p").alias("_hp"), "_b", *(F.col(k).alias(f"_h{i}") for i, k in enumerate(by)))
    same = F.col("_p") == F.col("_hp")
    for i, k in enumerate(by):
        same = same & F.col(k).eqNullSafe(F.col(f"_h{i}"))
    out = placed.join(F.broadcast(handed), same, "left")
    both = {"last": F.coalesce("_o", "_b"), "sum": F.when(F.col("_b").isNull(), F.col("_o")).otherwise(F.col("_b") + F.coalesce("_o", F.lit(0))), "max": F.greatest("_o", "_b")}[how]
    return out.withColumn(name, both).drop("_v", "_o", "_b", "_hp", *(f"_h{i}" for i in range(len(by))))
