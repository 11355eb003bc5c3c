"""Tables written between the steps of a job, where lineage has to end or a step has to be read twice."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; where it is unset, a temporary folder of a local session and, on a
    cluster, one below the warehouse, which its machines share. The session's settings aren't changed."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        return f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='spark-scratch-')}"
    return _LOCAL[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch root, which goes when the driver's JVM ends."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)
    fs.deleteOnExit(hadoop)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to a new folder below the scratch root and read it back: lineage ends there."""
    path = f"{scratch_path(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
