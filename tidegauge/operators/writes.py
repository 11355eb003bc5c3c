"""Write semantics as table-to-table operations, and their writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: list[str], version: str) -> DataFrame:
    """Union of both with the row of the highest version of each key; of equal versions the new one."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    w = Window.partitionBy(*key).orderBy(F.desc(version), F.desc("_new"))
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_new")


def insert_absent(old: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """old and the first new row of each key that old doesn't have."""
    w = Window.partitionBy(*key).orderBy(*order)
    once = new.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return old.unionByName(once.join(old.select(*key), key, "left_anti"))


def merge_additive(tables: list[DataFrame], key: list[str], sums: list[str], latest: list[str], order: str) -> DataFrame:
    """Counts and volumes add up; other columns take their latest value that isn't null."""
    both = tables[0]
    for t in tables[1:]:
        both = both.unionByName(t)
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in latest]
    return both.groupBy(*key).agg(*(F.sum(c).alias(c) for c in sums), *last)


def coalescing_upsert(old: DataFrame, new: DataFrame, key: list[str], replaced: list[str], kept: list[str]) -> DataFrame:
    """New values replace the ``replaced`` columns of keys that new has; ``kept`` ones stay where new has null."""
    o = old.select(*key, *(F.col(c).alias(f"_o_{c}") for c in [*replaced, *kept]))
    n = new.select(*key, *(F.col(c).alias(f"_n_{c}") for c in [*replaced, *kept]), F.lit(True).alias("_has"))
    j = o.join(n, key, "full")
    swap = [F.when(F.col("_has"), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c) for c in replaced]
    return j.select(*key, *swap, *(F.coalesce(f"_n_{c}", f"_o_{c}").alias(c) for c in kept))


def snapshot_replace(old: DataFrame, new: DataFrame, key: list[str], flag: str = "tradable") -> DataFrame:
    """Rows of new with the flag true, and those only old has with the flag false."""
    gone = old.drop(flag).join(new.select(*key), key, "left_anti").withColumn(flag, F.lit(False))
    return new.drop(flag).withColumn(flag, F.lit(True)).unionByName(gone)


def surrogate_keys(dimension: DataFrame, facts: DataFrame, natural: list[str], key: str) -> DataFrame:
    """The dimension with a row for each natural key that only facts have; its surrogate is a hash of it."""
    fresh = facts.select(*natural).distinct().join(dimension.select(*natural), natural, "left_anti")
    return dimension.unionByName(fresh.withColumn(key, F.xxhash64(*natural)), allowMissingColumns=True)


def alerts_to_append(prior: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """Found alerts that aren't there yet, each key once."""
    return found.dropDuplicates(key).join(prior.select(*key), key, "left_anti")


def ledger_rows(df: DataFrame, definition: list[str], version: str) -> DataFrame:
    """Rows with their frozen definition as JSON and its SHA-256."""
    return df.withColumn("frozen_definition", F.to_json(F.struct(*definition))).withColumn("definition_hash", F.sha2("frozen_definition", 256)).withColumn("contract", F.lit(version))


def replace_slice(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Overwrite only the partitions that df has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_segments(df: DataFrame, path: str, partitions: list[str]) -> DataFrame:
    """Gzip JSON lines below a folder for each partition; returns the manifest of what is stored."""
    df.repartition(*partitions, F.pmod(F.xxhash64(*df.columns), F.lit(8))).write.mode("append").option("compression", "gzip").partitionBy(*partitions).json(path)
    return segment_manifest(df.sparkSession, path, {f.name: f.dataType.simpleString() for f in df.schema if f.name in partitions})


def segment_manifest(spark: SparkSession, path: str, partitions: dict[str, str]) -> DataFrame:
    """One row per stored object: path, its partitions' values, rows, bytes and checksum (SHA-256 of the object)."""
    objects = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json.gz").load(path)
    facts = objects.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("checksum"))
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json.gz").text(path)
    counted = lines.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count("*").alias("rows"))
    bare = lambda c: F.regexp_replace(F.url_decode(c), r"^[a-z]+:/+", "/")
    value = lambda n: F.nullif(F.regexp_extract(F.url_decode("path"), f"/{n}=([^/]*)/", 1), F.lit("__HIVE_DEFAULT_PARTITION__"))
    both = facts.join(counted, bare(F.col("path")) == bare(F.col("_file")), "left")
    return both.select("path", *(value(n).cast(t).alias(n) for n, t in partitions.items()), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "bytes", "checksum")


def export_csv(tables: dict[str, DataFrame], path: str) -> None:
    """Each table as CSV files with header, nested columns as JSON."""
    for name, t in tables.items():
        flat = [F.to_json(c).alias(c) if d.startswith(("struct", "array", "map")) else F.col(c) for c, d in t.dtypes]
        t.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/{name}")


