"""Versioned snapshot tables: never read and overwrite the same path.

Layout: ``<path>/<folder>/`` data folders, one per attempt, plus an append-only
``<path>/_log`` Parquet table of committed versions with their folder. A version
becomes current only after its data write succeeded and its log row was
appended; a folder that no log row names (a failed attempt) is never read, so a
failed or retried job neither exposes a half-written snapshot nor blocks later
ones. Read errors are raised, never taken for an empty table.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SnapshotTable:
    LOG_SCHEMA = "version bigint, committed_at bigint, folder string, batch string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        # open-or-create: an empty append gives the log folder its schema, so
        # reading a new table's log never fails
        spark.createDataFrame([], self.LOG_SCHEMA).write.mode("append").parquet(f"{self.path}/_log")

    def _log(self) -> DataFrame:
        return self.spark.read.schema(self.LOG_SCHEMA).parquet(f"{self.path}/_log")

    def latest(self) -> tuple[int, str] | None:
        """(version, folder) of the current version."""
        row = self._log().agg(F.max(F.struct("version", "committed_at", "folder")).alias("v")).first()["v"]
        return None if row is None else (int(row["version"]), row["folder"])

    def version(self) -> int | None:
        found = self.latest()
        return found and found[0]

    def current(self) -> DataFrame | None:
        found = self.latest()
        return None if found is None else self.spark.read.parquet(f"{self.path}/{found[1]}")

    def has_batch(self, batch: str) -> bool:
        """Whether a version of this stream batch is committed (a retried batch is then left out)."""
        return not self._log().where(F.col("batch") == batch).isEmpty()

    def commit(self, df: DataFrame, partition_by: list[str] | None = None, batch: str | None = None) -> int:
        v = (self.version() or 0) + 1
        folder = f"v={v}-{uuid.uuid4().hex}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.path}/{folder}")
        now = int(datetime.now(timezone.utc).timestamp() * 1000)
        self.spark.createDataFrame([(v, now, folder, batch)], self.LOG_SCHEMA) \
            .write.mode("append").parquet(f"{self.path}/_log")
        return v
