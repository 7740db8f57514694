"""Which landed files a feed has taken in.

The manifest is a table of its own below ``root``, one folder per run::

    run_id=ID/          path key, size, modification time and verdict of the files of that run

A run takes the listed files that no earlier run has recorded in the same form, so a file that is landed again with other
content counts as new.  Recording overwrites the run's own folder: a run that is started again finds the same files and leaves
one set of entries.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import path_key

ENTRY = "path_key string, size long, modified timestamp, ok boolean, run_id string"
SAME_FILE = ["path_key", "size", "modified"]


class Manifest:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def entries(self) -> DataFrame:
        """All recorded files, also before the first run."""
        try:
            return self.spark.read.schema(ENTRY).parquet(self.root)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ENTRY)

    def pending(self, listed: DataFrame, run_id: str) -> DataFrame:
        """The files of a listing (``path, size, modified``) that no run before ``run_id`` has taken."""
        before = self.entries().where(F.col("run_id") < run_id).select(*SAME_FILE).distinct()
        keyed = listed.withColumn("path_key", path_key(F.col("path")))
        return keyed.join(before, SAME_FILE, "left_anti").drop("path_key")

    def record(self, files: DataFrame, run_id: str) -> None:
        """Note the files (``path, size, modified, ok``) of a run, once their rows are stored."""
        rows = files.select(path_key(F.col("path")).alias("path_key"), "size", "modified", "ok")
        rows.write.mode("overwrite").parquet(f"{self.root}/run_id={run_id}")
