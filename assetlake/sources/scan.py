"""Scans: tenants backed by Parquet folders, delta (incremental) reads, and
the delta high-water-mark state table (A16-A19)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESOURCES = ("assets", "data_sets", "events", "files", "labels", "relationships", "raw_rows",
             "sequence_headers", "sequence_rows", "sequence_body", "ts_headers", "ts_points")


class ParquetTenant:
    """A tenant whose resources are Parquet folders ``<root>/<resource>``."""

    def __init__(self, spark: SparkSession, root: str, content_dir: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.content_dir = content_dir  # file bodies by directory and name, where the files table holds none

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def __getattr__(self, name: str):
        if name in RESOURCES:
            return lambda: self.table(name)
        raise AttributeError(name)


def materialize(tenant, root: str, resources=RESOURCES, mode: str = "overwrite") -> ParquetTenant:
    """Write every resource of ``tenant`` under ``root`` (e.g. to snapshot a derived tenant)."""
    spark = None
    for r in resources:
        df = getattr(tenant, r)()
        spark = df.sparkSession
        df.write.mode(mode).parquet(f"{root.rstrip('/')}/{r}")
    return ParquetTenant(spark, root)


def scan(df: DataFrame, **equals) -> DataFrame:
    """A scan whose request carries filters (column == value or isin list)."""
    for c, v in equals.items():
        df = df.filter(F.col(c).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(c) == v)
    return df


def delta_since(df: DataFrame, since_ms: int, offset_ms: int, column: str = "last_updated_time") -> DataFrame:
    """Rows updated after ``since - offset`` (the safety overlap)."""
    return df.filter(F.col(column) > F.lit(int(since_ms) - int(offset_ms)))


def upper_bound(df: DataFrame, until_ms: int, column: str = "last_updated_time") -> DataFrame:
    """``last_updated_time <= run time`` for a repeatable snapshot."""
    return df.filter(F.col(column) <= F.lit(int(until_ms)))


class DeltaState:
    """A17 high-water marks in a small Parquet table ``(identifier, mark, committed_at)``.

    Marks are appended, never rewritten in place; the current mark of an
    identifier is the latest committed row. Commit only after the sink has
    succeeded (at-least-once with idempotent upserts).
    """

    SCHEMA = "identifier string, mark bigint, committed_at bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        # open-or-create, so reading the marks of a new state table never fails
        spark.createDataFrame([], self.SCHEMA).write.mode("append").parquet(path)

    def read(self, identifier: str) -> int | None:
        """The current mark; a read error is raised, never taken for "no mark" (that would be a silent full read)."""
        row = (self.spark.read.schema(self.SCHEMA).parquet(self.path).filter(F.col("identifier") == identifier)
               .agg(F.max_by("mark", "committed_at").alias("m")).first())
        return None if row is None or row["m"] is None else int(row["m"])

    def scan(self, df: DataFrame, identifier: str, offset_ms: int, full_read: bool = False,
             column: str = "last_updated_time") -> DataFrame:
        """Delta read unless ``full_read`` or no mark yet."""
        mark = None if full_read else self.read(identifier)
        return df if mark is None else delta_since(df, mark, offset_ms, column)

    def commit(self, identifier: str, written: DataFrame, column: str = "last_updated_time") -> int | None:
        """Store ``max(column)`` of what was written (or keep the old mark when empty)."""
        return self.advance(identifier, written.agg(F.max(column).alias("m")).first()["m"])

    def advance(self, identifier: str, new: int | None) -> int | None:
        """Store a mark that was observed by the job itself; a mark never goes back, None keeps it."""
        old = self.read(identifier)
        mark = new if old is None else (old if new is None else max(int(new), old))
        if mark is None:
            return None
        now = int(datetime.now(timezone.utc).timestamp() * 1000)
        self.spark.createDataFrame([(identifier, int(mark), now)], self.SCHEMA) \
            .write.mode("append").parquet(self.path)
        return int(mark)
