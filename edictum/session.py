"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot host, run or source must be split even if that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are written for."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, from ``spark.checkpoint.dir``.

    Only a session on a local master without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="edictum-"))
    return spark.sparkContext.getCheckpointDir()


def stage(df: DataFrame) -> DataFrame:
    """Write an expensive result that several later steps read, as Parquet, and read it back.

    A later step that needs two columns reads two columns, sizes are known to the planner, and a
    lost executor costs a new read and not a new extraction. The folder goes with the application.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)
