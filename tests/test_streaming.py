"""Streaming delta publish equals the batch result."""

import os

from pyspark.sql import functions as F

from assetlake.operators.timeseries import hourly_aggregates
from assetlake.streaming.delta_publish import hourly_rollup, stream_upsert


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_upsert_equals_batch(spark, tenants, tmp_dir):
    src, _ = tenants
    events = src.events().select("id", "external_id", "start_time", "end_time", "last_updated_time")
    inbox = os.path.join(tmp_dir, "inbox")
    lo, hi = events.approxQuantile("last_updated_time", [0.5], 0.0)[0], None
    events.filter(F.col("last_updated_time") <= lo).write.parquet(os.path.join(inbox, "part1"))
    snap_path, ckpt = os.path.join(tmp_dir, "snap"), os.path.join(tmp_dir, "ckpt")
    schema = events.schema
    stream_upsert(spark, os.path.join(inbox, "*"), schema, snap_path, ckpt, ["id"])
    # a second delivery, overlapping the first (re-sent rows must not duplicate)
    events.filter(F.col("last_updated_time") >= lo).write.parquet(os.path.join(inbox, "part2"))
    snap = stream_upsert(spark, os.path.join(inbox, "*"), schema, snap_path, ckpt, ["id"])
    assert _set(snap.current()) == _set(events)


def test_hourly_rollup_stream_equals_batch(spark, tenants, tmp_dir):
    src, _ = tenants
    pts = src.ts_points().filter(F.col("value").isNotNull()).select(
        "id", F.timestamp_millis("timestamp").alias("ts"), "value", "timestamp")
    inbox = os.path.join(tmp_dir, "points")
    pts.select("id", "ts", "value").write.parquet(inbox)
    stream = spark.readStream.schema("id long, ts timestamp, value double").parquet(inbox)
    q = (hourly_rollup(stream).writeStream.outputMode("complete").format("memory")
         .queryName("rollup_test").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("rollup_test").select("id", "hour", "count", "min", "max", F.round("sum", 6))
    batch = hourly_aggregates(pts.select("id", F.lit(None).cast("string").alias("external_id"), "timestamp",
                                         "value", F.lit(False).alias("is_step")))
    want = batch.select("id", "hour", "count", "min", "max", F.round("sum", 6))
    assert _set(got) == _set(want)
