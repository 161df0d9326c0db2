"""G1: group rows into batches of at most ``n`` per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def batch_rows(df: DataFrame, key: Column, order_col: str, n: int = 20, spread: int = 1) -> DataFrame:
    """(bucket, batch, items[]) with ``items`` holding at most ``n`` values of ``order_col``.

    The key is a row-level expression (e.g. a hash bucket), not one key drawn
    once for the whole input, so batches of different keys build in parallel.
    No batch holds more than ``n`` rows. ``spread`` > 1 splits every key into
    that many hash sub-groups that are numbered independently, so a key
    holding a large share of the rows is sorted by many tasks, not one.
    """
    df = df.withColumn("bucket", key.cast("long"))
    part = ["bucket"]
    if spread > 1:
        df = df.withColumn("__sub", F.pmod(F.xxhash64(order_col), F.lit(spread)))
        part.append("__sub")
    w = Window.partitionBy(*part).orderBy(order_col)
    batch = F.floor((F.row_number().over(w) - 1) / F.lit(n)).cast("long")
    if spread > 1:
        batch = batch * spread + F.col("__sub")
    return (df.withColumn("batch", batch)
            .groupBy("bucket", "batch")
            .agg(F.array_sort(F.collect_list(order_col)).alias("items")))
