"""Helpers shared by the training-data operators.

Intermediate tables are written as Parquet under the cluster's shared
``spark.checkpoint.dir`` (``store``): lineage is cut there, a lost executor
costs only a reread, and every reader sees the same files.
"""

from __future__ import annotations

import gc
import uuid
from contextlib import suppress
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.session import scratch_dir

_made: ContextVar[list | None] = ContextVar("made", default=None)  # tables stored inside the ``settle`` that runs

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LISTENERS_MS = 10_000  # how long ``tidy`` waits for Spark's listeners
WORDS = 1 << 17  # longs of a mask of keys: 8 million bits, however many keys there are


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder of its own below the shared scratch folder of this application."""
    return scratch_dir(spark, f"llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    if _made.get() is not None:
        _made.get().append(out)
    return out


def settle(make, name: str) -> DataFrame:
    """``store`` the DataFrame that ``make()`` returns, then delete the other tables that ``store`` wrote meanwhile and let
    Spark's cleaner drop their shuffle files: what stays on disk is the result."""
    token = _made.set([])
    try:
        out = store(make(), name)
        made = _made.get()
    finally:
        _made.reset(token)
    discard(*[t for t in made if t.stored_path != out.stored_path])
    if _made.get() is not None:
        _made.get().append(out)
    tidy(out.sparkSession)
    return out


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of DataFrames that are no longer referenced."""
    gc.collect()
    queue = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", ())
    with suppress(IndexError):  # py4j's own thread tells the JVM of what Python no longer holds as well, but once a second
        while queue and isinstance(queue[-1], tuple):
            client, target = queue.pop()
            client.garbage_collect_object(target, False)
    spark.range(0, 1, 1, 1).collect()  # Spark's threads hold the last job that ran
    with suppress(Py4JJavaError):  # and its listeners queries that have ended; if they lag for long, a later call cleans up
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(LISTENERS_MS)
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*stored: DataFrame) -> None:
    """Delete tables made by ``store`` that nothing still to be computed reads."""
    for df in stored:
        _delete(df.sparkSession, df.stored_path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; call it once the results are written."""
    _delete(spark, scratch_dir(spark, f"llm-{spark.sparkContext.applicationId}"))


def split_buckets(labelled: DataFrame, cell: int, carry: DataFrame | None = None, room: int | None = None) -> DataFrame:
    """Cells that compare the members (bucket, id, comp) of every bucket across components.

    A bucket's members outside its largest component are probes; each is compared with every member. Members are dealt into blocks of about ``cell``, probes into blocks of their own, and a cell is one
    block of each: (bucket, blk, pblk, probe, id, comp). Rows grow with members times probe blocks, so a bucket that is
    nearly one component is handed on nearly once, and no cell outgrows its task. Buckets within one component are left out.
    The columns of ``carry`` (id, ...) are joined to a bucket's members once, before they are dealt. With ``room``, a block's
    rows of ``labelled`` also have a summed column ``size`` of about ``room`` at most.
    """
    counts = labelled.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"), (F.sum("size") if room else F.lit(0)).alias("s"))
    blocks = lambda n: F.ceil(F.greatest(F.col(n) / F.lit(cell), F.col("s") / F.lit(room or 1))).cast("long")
    open_ = store(counts.groupBy("bucket").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("m"), F.sum("s").alias("s"))
                  .withColumn("o", F.col("m") - F.col("top.c")).where("o > 0")
                  .select("bucket", F.col("top.comp").alias("main"), blocks("m").alias("nb"), blocks("o").alias("no")), "cells-open")
    rows = labelled.join(open_, "bucket")
    rows = rows.drop("size") if room else rows
    if carry is not None:
        rows = rows.join(carry, "id")
    place = lambda blk, pblk, probe: F.struct(blk.alias("blk"), pblk.alias("pblk"), F.lit(probe).alias("probe"))
    up_to = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    as_member = F.transform(up_to("no"), lambda k: place(F.pmod(F.xxhash64("id"), "nb"), k, False))
    as_probe = F.transform(up_to("nb"), lambda k: place(k, F.pmod(F.xxhash64("id"), "no"), True))
    dealt = rows.withColumn("cell", F.explode(F.when(F.col("comp") != F.col("main"), F.concat(as_member, as_probe)).otherwise(as_member)))
    return dealt.select("bucket", "cell.*", "id", "comp", *([c for c in carry.columns if c != "id"] if carry is not None else []))


def _masked(rows: DataFrame, on: str, keys: DataFrame, how: str) -> DataFrame:
    """``rows`` with ``__may``: whether column ``on`` may be among the values of the first column of ``keys``."""
    def place(c):  # as text, so an int and a long are the same key
        return F.xxhash64(F.col(c).cast("string"))

    def bit(c):
        return F.shiftright(place(c), 32).bitwiseAND(63).cast("int")

    word = lambda c: F.pmod(place(c), F.lit(WORDS))
    key = keys.columns[0]
    mask = keys.groupBy(word(key).alias("__word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit(key))).alias("__bits"))
    found = rows.join(F.broadcast(mask), word(on) == F.col("__word"), how)
    return found.withColumn("__may", F.coalesce(F.getbit("__bits", bit(on)) == 1, F.lit(False))).drop("__word", "__bits")


def among(rows: DataFrame, on: str, keys: DataFrame) -> DataFrame:
    """The rows whose column ``on`` is among ``keys`` (one column), and few others.

    For joins of wide rows with few keys: what surely has no partner isn't shuffled. The keys are sent as a mask of at
    most ``WORDS`` longs; with many more keys than bits, all rows are left to the join.
    """
    return _masked(rows, on, keys, "inner").where("__may").drop("__may")


def apart(rows: DataFrame, on: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``among``'s rows and all others."""
    rows = _masked(rows, on, keys, "left")
    return rows.where("__may").drop("__may"), rows.where("not __may").drop("__may")


def bounded_batches(spark: SparkSession, rows: int = 512) -> None:
    """Rows per Arrow batch: what a Python task holds at once, whatever the table's size."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def lower_ascii(c):
    """Lower-case A-Z only; NULL counts as empty."""
    return F.translate(F.coalesce(c, F.lit("")), UPPER, UPPER.lower())


def unclash(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns alone, so extra columns of the input can't clash with the operator's own."""
    return df.select(*[F.col(f"`{c}`") for c in wanted])


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Distributed union-find: (node, component_id) for every node of ``edges`` (src, dst).

    Alternating large-star and small-star steps; a step only takes minima (partial
    aggregation) and joins them back, so a hub with very many links is split by
    AQE's skew join and never gathered. Ends when a step changes nothing; a step's
    tables are deleted once the next is written;
    ``component_id`` is the smallest node of the component. Self links and NULLs
    are dropped, repeated links count once. An empty input gives an empty result.
    """
    def mark(df):
        r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    cur = store(edges.select(F.greatest("src", "dst").cast("long").alias("u"),
                             F.least("src", "dst").cast("long").alias("v"))
                .where("u > v").distinct(), f"{name}-edges")
    before = mark(cur)
    while before[0]:
        sym = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = store(sym.groupBy("u").agg(F.min("v").alias("m"))
                    .select("u", F.least("u", "m").alias("m")), f"{name}-large")
        big = store(sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionByName(low.where("m < u").select("u", F.col("m").alias("v")))
                    .distinct(), f"{name}-star")
        low2 = store(big.groupBy("u").agg(F.min("v").alias("m")), f"{name}-small")
        nxt = store(big.join(low2, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionByName(low2.select("u", F.col("m").alias("v")))
                    .distinct(), f"{name}-step")
        discard(low, big, low2, cur)
        after, cur = mark(nxt), nxt
        if after == before:
            break
        before = after
    roots = cur.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component_id"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component_id")).unionByName(roots)
