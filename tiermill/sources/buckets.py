"""A keyed table stored in hash buckets, merged by rewriting only the buckets a feed touches.

::

    data/run_id=ID/attempt=A/bucket=B/      rows of one bucket as a run left it
    log/run_id=ID/                          one row per bucket the run rewrote: bucket, attempt, rows

A bucket's rows are in the folder of the newest log entry that names it.  Data are written before the log, and every attempt
has folders of its own, so a run that was broken off or is started again changes nothing until its log entry stands, and then
builds on the buckets as they were before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import keep_latest
from ..staging import stage

LOG = "bucket int, attempt string, n_rows long, run_id string"


class BucketedTable:
    """``buckets`` is fixed for the life of the table: about the number of files a full rewrite should have."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.buckets = buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).json(f"{self.root}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG)

    def _places(self, before: str | None = None) -> DataFrame:
        """Where each bucket's rows are: one row per bucket, of the newest run (of those below ``before``)."""
        log = self.log() if before is None else self.log().where(F.col("run_id") < before)
        newest = F.max_by(F.struct("run_id", "attempt", "n_rows"), "run_id").alias("place")
        return log.groupBy("bucket").agg(newest).where("place.n_rows > 0").select("bucket", "place.run_id", "place.attempt")

    def _read(self, places: DataFrame) -> DataFrame | None:
        """The rows of the named buckets: at most one folder per bucket."""
        folders = [f"{self.root}/data/run_id={p.run_id}/attempt={p.attempt}/bucket={p.bucket}" for p in places.collect()]
        return self.spark.read.parquet(*folders) if folders else None

    def read(self) -> DataFrame | None:
        """All rows as of the newest run; None before the first."""
        return self._read(self._places())

    def merge(self, incoming: DataFrame, order_by: Sequence[Column | str], run_id: str) -> DataFrame:
        """Merge a feed, the newest row per key winning, and return what was rewritten: bucket, attempt, n_rows, run_id.

        Buckets without a key of the feed are neither read nor written.  A bucket holds whole keys, so rows of the feed and
        of the table meet in one shuffle of the touched buckets alone; keep-latest drops all but one row per key and task
        before it.
        """
        feed = stage(incoming.withColumn("__bucket", self.bucket()), "feed")
        touched = feed.select(F.col("__bucket").alias("bucket")).distinct()
        before = self._read(self._places(run_id).join(F.broadcast(touched), "bucket", "left_semi"))  # at most all buckets
        rows = feed.drop("__bucket")
        if before is not None:
            rows = before.unionByName(rows, allowMissingColumns=True)
        attempt = f"a{uuid.uuid4().hex}"
        merged = keep_latest(rows, self.keys, order_by).withColumn("bucket", self.bucket())
        folder = f"{self.root}/data/run_id={run_id}/attempt={attempt}"
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        written = self.spark.read.schema(merged.schema).parquet(folder).groupBy("bucket").agg(F.count("*").alias("n_rows"))
        entry = written.select("bucket", F.lit(attempt).alias("attempt"), "n_rows")
        entry.coalesce(1).write.mode("overwrite").json(f"{self.root}/log/run_id={run_id}")  # one row per touched bucket
        return self.log().where(F.col("run_id") == run_id)
