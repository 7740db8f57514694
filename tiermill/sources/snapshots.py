"""Snapshot storage of a refined dataset.

Layout below ``root``::

    history/year=YYYY/month=MM/snapshot_id=ID/attempt=A/   immutable snapshots
    current/                                     copy of the newest snapshot
    log/snapshot_id=ID/                          one-row entry per committed snapshot

A snapshot becomes visible when its log entry is written, after its data.  Every attempt has a folder of its own and the
log names the one that counts, so a job that lost executors or was restarted can simply run again, even if it reads what
it replaces.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cdc import classify_changes

_LOG_SCHEMA = "folder string, run_date date, snapshot_id string"


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def current_path(self) -> str:
        return f"{self.root}/current"

    def _entries(self, n: int, before: str | None = None):
        """The newest ``n`` log entries (of ids below ``before``): one small row per snapshot, ordered by id."""
        try:
            log = self.spark.read.schema(_LOG_SCHEMA).json(f"{self.root}/log")
            log = log if before is None else log.filter(F.col("snapshot_id") < before)
            return log.orderBy(F.desc("snapshot_id")).limit(n).collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return []
            raise

    def ids(self, n: int = 2) -> list[str]:
        return [e.snapshot_id for e in self._entries(n)]

    def _read(self, entry) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{entry.folder}")

    def latest(self, before: str | None = None) -> DataFrame | None:
        """The newest snapshot; with ``before``, the newest of a smaller id, which a re-run of that id builds on."""
        entries = self._entries(1, before)
        return self._read(entries[0]) if entries else None

    def latest_two(self) -> tuple[DataFrame | None, DataFrame | None]:
        """(current, previous); a missing snapshot is None."""
        entries = [self._read(e) for e in self._entries(2)]
        current, previous = (entries + [None, None])[:2]
        return current, previous

    def history(self) -> DataFrame:
        """All committed snapshots with ``year``, ``month`` and ``snapshot_id`` as partition columns.

        The log restricts the scan to committed folders by partition pruning.
        """
        spark = self.spark
        rows = spark.read.option("basePath", f"{self.root}/history").parquet(f"{self.root}/history")
        rows = rows.withColumn("snapshot_id", F.col("snapshot_id").cast("string"))
        log = spark.read.schema(_LOG_SCHEMA).json(f"{self.root}/log")
        log = log.select("snapshot_id", F.regexp_extract("folder", "attempt=([^/]+)", 1).alias("attempt"))
        return rows.join(log, ["snapshot_id", "attempt"], "left_semi").drop("attempt")

    def write(self, df: DataFrame, snapshot_id: str, run_date: date, current_copy: bool = True) -> DataFrame:
        """Commit ``df`` as a snapshot and return it as stored.

        Ids must grow from run to run.  The plan of ``df`` runs once; the current copy is made from the stored files.
        """
        folder, stored = self._store(df, snapshot_id, run_date)
        self._commit(folder, stored, snapshot_id, run_date, current_copy)
        return stored

    def _store(self, df: DataFrame, snapshot_id: str, run_date: date) -> tuple[str, DataFrame]:
        if not re.fullmatch(r"[0-9A-Za-z_.-]+", snapshot_id):
            raise ValueError(f"snapshot id {snapshot_id!r} is not a plain name")
        newest = self.ids(1)
        if newest and snapshot_id < newest[0]:
            raise ValueError(f"snapshot id {snapshot_id!r} is older than {newest[0]!r}")
        folder = f"history/year={run_date:%Y}/month={run_date:%m}/snapshot_id={snapshot_id}/attempt=a{uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(f"{self.root}/{folder}")
        return folder, self.spark.read.schema(df.schema).parquet(f"{self.root}/{folder}")

    def _commit(
        self, folder: str, stored: DataFrame, snapshot_id: str, run_date: date, current_copy: bool
    ) -> None:
        if current_copy:
            stored.write.mode("overwrite").parquet(self.current_path)
        entry = self.spark.createDataFrame([(folder, run_date)], "folder string, run_date date")
        entry.write.mode("overwrite").json(f"{self.root}/log/snapshot_id={snapshot_id}")

    def write_if_changed(
        self,
        df: DataFrame,
        keys: Sequence[str],
        snapshot_id: str,
        run_date: date,
        current_copy: bool = True,
    ) -> bool:
        """Commit only when a row is new, changed or gone compared with the latest snapshot.

        ``df`` is computed once: its files are stored first and compared from there.  Without a difference they are
        replaced by an empty folder that is never committed, and the current copy stays.
        """
        committed = self.ids(1)
        previous = self.latest()
        folder, stored = self._store(df, snapshot_id, run_date)
        if previous is not None and committed[0] != snapshot_id:
            changes = classify_changes(previous, stored, keys, deletes=True)
            if changes.filter(F.col("change") != "U").isEmpty():
                self.spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{self.root}/{folder}")
                return False
        self._commit(folder, stored, snapshot_id, run_date, current_copy)
        return True
