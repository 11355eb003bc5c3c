"""Cross-sections: what all entities are like at one time, ranks within it, panels of a fixed membership."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def market_state(df: DataFrame, bucket: str, value: str, named: dict[str, str] | None = None, entity: str = "entity") -> DataFrame:
    """Per bucket: n, breadth (share above zero), mean, median, sample dispersion, 10 and 90 % points, named entities' values."""
    picks = [F.max(F.when(F.col(entity) == e, F.col(value))).alias(name) for name, e in (named or {}).items()]
    return df.where(F.col(value).isNotNull()).groupBy(bucket).agg(
        F.count("*").alias("n"),
        F.avg((F.col(value) > 0).cast("double")).alias("breadth"),
        F.avg(value).alias("mean"),
        F.percentile(value, F.lit(0.5)).alias("median"),
        F.stddev_samp(value).alias("dispersion"),
        F.percentile(value, F.lit(0.1)).alias("p10"),
        F.percentile(value, F.lit(0.9)).alias("p90"),
        *picks,
    )


def percent_ranks(df: DataFrame, bucket: str, columns: list[str], suffix: str = "_rank") -> DataFrame:
    """Percent rank of each column within its bucket; rows with a null there are left out."""
    solid = df.dropna(subset=columns)
    return solid.withColumns({f"{c}{suffix}": F.percent_rank().over(Window.partitionBy(bucket).orderBy(c)) for c in columns})


def tiles(df: DataFrame, bucket: str, columns: list[str], entity: str, n: int = 5, suffix: str = "_tile") -> DataFrame:
    """n-tiles of each column within its bucket, ties broken by entity."""
    return df.withColumns({f"{c}{suffix}": F.ntile(n).over(Window.partitionBy(bucket).orderBy(c, entity)) for c in columns})


def complete_only(df: DataFrame, bucket: str, entity: str, members: int) -> DataFrame:
    """Rows of buckets in which exactly ``members`` distinct entities are present."""
    whole = df.groupBy(bucket).agg(F.count_distinct(entity).alias("_m")).where(F.col("_m") == members).select(bucket)
    return df.join(whole, bucket, "left_semi")


def panel_mean(df: DataFrame, bucket: str, value: str, members: int) -> DataFrame:
    """Equal-weight mean of buckets with exactly ``members`` values."""
    return df.where(F.col(value).isNotNull()).groupBy(bucket).agg(F.avg(value).alias("panel"), F.count("*").alias("members")).where(F.col("members") == members)


def leave_one_out_mean(df: DataFrame, bucket: list[str], value: str, name: str = "peers") -> DataFrame:
    """Every row with the mean of the other rows of its bucket: bucket sums less its own, so peers aren't listed."""
    total = df.where(F.col(value).isNotNull()).groupBy(*bucket).agg(F.sum(value).alias("_s"), F.count("*").alias("_n"))
    out = df.join(total, bucket, "left")
    own = F.when(F.col(value).isNotNull(), 1).otherwise(0)
    return out.withColumn(name, F.try_divide(F.col("_s") - F.coalesce(value, F.lit(0.0)), F.col("_n") - own)).drop("_s", "_n")


def phase_ladder(df: DataFrame, ts: str, value: str, passes: str) -> tuple[DataFrame, DataFrame]:
    """From times to clock phases to one summary: mean, count and whether all of a phase pass; then shares over phases."""
    phases = df.groupBy("phase").agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.bool_and(passes).alias("strict"))
    summary = phases.agg(
        F.count("*").alias("phases"),
        F.count_if("strict").alias("strict_phases"),
        F.count_if(F.col("mean") > 0).alias("positive_phases"),
        F.percentile("mean", F.lit(0.5)).alias("median_mean"),
        F.min("mean").alias("worst_mean"),
    )
    return phases, summary
