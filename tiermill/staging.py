"""Cutting lineage through files in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="tiermill-")


def stage(df: DataFrame, name: str, cluster_by: str | None = None, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet and read it back, so later consumers never recompute it.

    ``cluster_by`` asks Spark to rebalance rows by that column: files hold few values each (row-group statistics
    then prune), small partitions are merged and oversized ones split.  ``partition_by`` writes a folder per value.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tiermill-stage/{uuid.uuid4().hex}/{name}"
    writer = (df.hint("rebalance", cluster_by) if cluster_by else df).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete what ``stage`` wrote for these; nothing may read them, or what was derived from them, any more."""
    for df in staged:
        spark, path = df.sparkSession, df.staged_at
        jvm = spark._jvm  # Hadoop's file system is the one Spark wrote through
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
