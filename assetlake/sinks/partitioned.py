"""Parquet tables in one folder per partition value, replaced partition by partition.

An upsert rewrites only the partitions its rows fall into; the files of all others stay as they are. The delta is
written once, as files of the new partitions, and read back from them, so a wave reads its own partitions only. The
target is read where it lies: of each touched partition the rows whose keys the delta replaces are left out by an
anti-join with the delta's keys, which are broadcast. Touched partitions are dealt into waves whose keys stay within
the broadcast limit, so no size of delta makes the target move through a shuffle; only partitions whose own keys are
beyond the limit are joined by a shuffle, all of them in one job. The first write has no target and needs no wave.

Partitions are written to ``_pending`` first and marked ready as a whole, then each folder is switched by a rename.
A failed write is never marked and is removed; a switch that was interrupted is finished by whoever opens the
table next. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins

READY = "_READY"


class Folder:
    """The few file-system calls a switch needs, on whatever store holds ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._make = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._make(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, path: str) -> list[str]:
        where = self._make(path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._make(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._make(path), True)

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._make(source), self._make(target)):
            raise OSError(f"{source} could not be moved to {target}")

    def mark(self, path: str) -> None:
        self._fs.create(self._make(path)).close()


def replace_table(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """B1: ``write`` a whole table to a hidden folder beside ``path``, then switch the two by renames.

    A write that fails leaves the old table as it was. A switch that was interrupted is settled by the next one:
    the new table if it was complete, else the old one.
    """
    folder, path = Folder(spark, path), path.rstrip("/")
    parent, name = path.rsplit("/", 1)
    new, old = f"{parent}/_new-{name}", f"{parent}/_old-{name}"
    if folder.exists(old) and not folder.exists(path):
        folder.move(new if folder.exists(f"{new}/_SUCCESS") else old, path)
    for left in (old, new):
        folder.delete(left)
    write(new)
    if folder.exists(path):
        folder.move(path, old)
    folder.move(new, path)
    folder.delete(old)


def hashable(df: DataFrame, c: str):
    """A column in a form that can be hashed (maps can't)."""
    kind = df.schema[c].dataType.simpleString()
    return F.to_json(F.col(c)) if "map<" in kind else F.col(c)


def without_key(df: DataFrame, keys: list[str], columns: list[str]):
    """A hash of the whole row if a key is NULL, else NULL: such rows match nothing but an equal row."""
    return F.when(F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1,
                  F.xxhash64(*[hashable(df, c) for c in columns]))


def keyless(keys: list[str]):
    """Whether a key is NULL."""
    return reduce(or_, [F.col(k).isNull() for k in keys])


def key_rows(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """__<key>..., __none: the keys of ``rows`` and ``without_key``; of rows that have their keys nothing else is read."""
    named = [F.col(k).alias(f"__{k}") for k in keys]
    return rows.where(~keyless(keys)).select(*named, F.lit(None).cast("long").alias("__none")).unionByName(
        rows.where(keyless(keys)).select(*named, without_key(rows, keys, columns).alias("__none")))


def same_key(keys: list[str]):
    """A row with ``without_key`` as __no_key against a row of ``key_rows``."""
    same = F.col("__no_key").eqNullSafe(F.col("__none"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return same


def latest(rows: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """One row a key: the largest ``newest`` if there is such a column, then the largest row hash."""
    cols = rows.columns
    order = F.struct(*([newest] if newest in cols else []), F.xxhash64(*[hashable(rows, c) for c in cols]))
    return (rows.groupBy(*[F.col(k).alias(f"__{k}") for k in keys], without_key(rows, keys, cols).alias("__no_key"))
            .agg(F.max_by(F.struct(*cols), order).alias("row")).select("row.*"))


class PartitionedTable:
    """Rows with a column ``part`` in folders ``<path>/<part>=<value>``."""

    def __init__(self, spark: SparkSession, path: str, part: str, keys: list[str], newest: str = "last_updated_time"):
        self.spark, self.path, self.part, self.keys, self.newest = spark, path.rstrip("/"), part, keys, newest
        self.folder = Folder(spark, self.path)
        self.recover()

    def place(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the partition column; tables that derive it override this."""
        return rows

    def dealt(self, delta: DataFrame) -> DataFrame:
        """``delta`` as its partitions' files are to be written: stored first, since the ranges are found by a pass of its own."""
        return delta.checkpoint().repartitionByRange(self.part, *self.keys)

    def stored(self) -> DataFrame | None:
        if not any(n.startswith(f"{self.part}=") for n in self.folder.names(self.path)):
            return None
        return self.spark.read.parquet(self.path)

    def current(self) -> DataFrame | None:
        """The table's rows, without the partition column; None before the first write."""
        rows = self.stored()
        return None if rows is None else rows.drop(self.part)

    def recover(self) -> None:
        """Finish switches that were interrupted, and remove what was never marked ready."""
        for name in self.folder.names(f"{self.path}/_pending"):
            pending = f"{self.path}/_pending/{name}"
            self._switch(pending) if self.folder.exists(f"{pending}/{READY}") else self.folder.delete(pending)

    def _switch(self, pending: str) -> None:
        for name in self.folder.names(pending):
            if name.startswith(f"{self.part}="):
                self.folder.delete(f"{self.path}/{name}")
                self.folder.move(f"{pending}/{name}", f"{self.path}/{name}")
        self.folder.delete(pending)

    def _within(self, parts: list) -> F.Column:
        known = [p for p in parts if p is not None]
        found = F.col(self.part).isin(known) if known else F.lit(False)
        return found if len(known) == len(parts) else found | F.col(self.part).isNull()

    def _waves(self, delta: DataFrame) -> list[tuple[list, bool]]:
        """(partitions, whether the delta's keys in them may be broadcast); the driver holds a row a partition."""
        size = F.octet_length(F.to_json(F.struct(*self.keys)))
        found = delta.groupBy(self.part).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).collect()
        waves: list[tuple[list, bool]] = []
        some: list = []
        large: list = []
        rows = held = 0
        for r in sorted(found, key=lambda r: r["bytes"]):
            if r["bytes"] > joins.BROADCAST_MAX_BYTES or r["n"] > joins.BROADCAST_MAX_ROWS:
                large.append(r[self.part])
                continue
            if not some or held + r["bytes"] > joins.BROADCAST_MAX_BYTES or rows + r["n"] > joins.BROADCAST_MAX_ROWS:
                some, rows, held = [], 0, 0
                waves.append((some, True))
            some.append(r[self.part])
            rows, held = rows + r["n"], held + r["bytes"]
        return waves + ([(large, False)] if large else [])

    def _aligned(self, delta: DataFrame, target: DataFrame) -> DataFrame:
        new = [c for c in delta.columns if c not in target.columns]
        if new:
            raise ValueError(f"the table has no columns {new}")
        return delta.select(*[(F.col(c) if c in delta.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in target.columns])

    def merged(self, target: DataFrame, delta: DataFrame, parts: list, small: bool) -> DataFrame:
        """The target's rows of the partitions ``parts`` that the delta doesn't replace."""
        columns = [c for c in target.columns if c != self.part]
        tagged = target.where(self._within(parts)).withColumn("__no_key", without_key(target, self.keys, columns))
        keys = key_rows(delta.where(self._within(parts)), self.keys, columns)
        return tagged.join(F.broadcast(keys) if small else keys, same_key(self.keys), "left_anti").drop("__no_key")

    def _write(self, rows: DataFrame) -> tuple[str, DataFrame]:
        """``rows`` as files of new partitions, not yet marked ready: their folder and themselves, read back."""
        pending = f"{self.path}/_pending/{uuid.uuid4().hex}"
        rows.write.partitionBy(self.part).parquet(pending)
        return pending, self.spark.read.schema(rows.schema).parquet(pending)

    def _once(self, delta: DataFrame) -> DataFrame | None:
        """The delta with one row a key (``latest``), None if it has that: only rows whose key repeats are reduced."""
        columns = delta.columns
        again = key_rows(delta, self.keys, columns).groupBy(*[f"__{k}" for k in self.keys], "__none").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
        again = again.drop("__n").checkpoint()
        if again.isEmpty():
            return None
        tagged = delta.withColumn("__no_key", without_key(delta, self.keys, columns))
        alone = tagged.join(again, same_key(self.keys), "left_anti").drop("__no_key")
        several = tagged.join(again, same_key(self.keys), "left_semi").drop("__no_key")
        return alone.unionByName(latest(several, self.keys, self.newest))

    def upsert(self, rows: DataFrame, unique: bool = False) -> list:
        """Replace rows of the same key as a whole, add the others; returns the partitions rewritten.

        ``unique`` says that ``rows`` hold a key once, so their keys aren't counted here.
        """
        delta = self.place(rows)
        target = self.stored()
        if target is not None:
            delta = self._aligned(delta, target)
        pending, delta = self._write(self.dealt(delta))
        once = None if unique else self._once(delta)
        if once is not None:
            given, (pending, delta) = pending, self._write(self.dealt(once))
            self.folder.delete(given)
        touched = []
        for parts, small in self._waves(delta):
            if target is not None:
                self.merged(target, delta, parts, small).write.mode("append").partitionBy(self.part).parquet(pending)
            touched += parts
        if touched:
            self.folder.mark(f"{pending}/{READY}")
            self._switch(pending)
        else:
            self.folder.delete(pending)
        return touched


class DayTable(PartitionedTable):
    """Points by day of ``timestamp`` (epoch milliseconds), keyed on (external_id, timestamp)."""

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = ("external_id", "timestamp"), time: str = "timestamp"):
        self.time = time
        super().__init__(spark, path, "p_date", list(keys))

    def place(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("p_date", F.to_date(F.timestamp_millis(self.time)))


class KeyedTable(PartitionedTable):
    """Rows dealt into a fixed number of buckets by the hash of their keys.

    The number is stored with the table when it is made; whoever opens the table later uses the stored one.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64):
        layout = f"{path.rstrip('/')}/_layout"
        if not Folder(spark, path).exists(f"{layout}/_SUCCESS"):
            spark.createDataFrame([(buckets, ",".join(keys))], "buckets int, keys string").coalesce(1).write.mode("overwrite").parquet(layout)
        known = spark.read.schema("buckets int, keys string").parquet(layout).first()
        if known["keys"] != ",".join(keys):
            raise ValueError(f"the table is keyed on {known['keys']}")
        self.buckets = known["buckets"]
        super().__init__(spark, path, "p_bucket", list(keys))

    def place(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("p_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def dealt(self, delta: DataFrame) -> DataFrame:
        """Buckets are even, so each is dealt by another hash of the keys and the rows move once, without a pass before."""
        shares = -(-2 * int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)
        return delta.repartition(self.part, F.pmod(F.xxhash64(F.lit(1), *self.keys), F.lit(shares)))
