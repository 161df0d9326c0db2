"""Faults found by review: sinks that survive failures, keys, late points, deep trees, pushed filters, text lines."""

import os

import pytest
from pyspark.sql import functions as F

from assetlake.operators import joins
from assetlake.operators.filters import allow_deny
from assetlake.operators.hierarchy import path_depth_children
from assetlake.plans import jobs
from assetlake.sinks.snapshot import SnapshotTable
from assetlake.sinks.upsert import upsert
from assetlake.streaming.delta_publish import hourly_rollup_snapshot


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_failed_commit_does_not_block_the_next(spark, tmp_dir):
    snap = SnapshotTable(spark, os.path.join(tmp_dir, "t"))
    snap.commit(spark.createDataFrame([(1,)], "x long"))
    with pytest.raises(Exception, match="boom"):
        snap.commit(spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("x")))
    spark.createDataFrame([(9,)], "x long").write.parquet(f"{snap.path}/v=2-crashed")  # data written, log row not
    assert _rows(snap.current()) == [(1,)]
    assert snap.commit(spark.createDataFrame([(2,)], "x long")) == 2 and _rows(snap.current()) == [(2,)]


def test_log_read_error_is_raised(spark, tmp_dir, monkeypatch):
    snap = SnapshotTable(spark, os.path.join(tmp_dir, "t"))
    snap.commit(spark.createDataFrame([(1,)], "x long"))

    def fail():
        raise OSError("store is away")

    monkeypatch.setattr(snap, "_log", fail)
    with pytest.raises(OSError):
        jobs._upsert_into(snap, spark.createDataFrame([(2,)], "x long"), ["x"])


def test_duplicate_and_null_keys_over_two_runs(spark, tmp_dir):
    snap = SnapshotTable(spark, os.path.join(tmp_dir, "t"))
    schema = "external_id string, last_updated_time long, v string, metadata map<string,string>"
    rows = spark.createDataFrame([("a", 1, "old", {"k": "1"}), ("a", 2, "new", {"k": "2"}), (None, 1, "x", None), (None, 1, "y", None)], schema)
    for _ in range(3):
        jobs._upsert_into(snap, rows, ["external_id"])
        assert _rows(snap.current().drop("metadata")) == [("a", 2, "new"), (None, 1, "x"), (None, 1, "y")]
    jobs._upsert_into(snap, spark.createDataFrame([("a", 1, "later run", None)], schema), ["external_id"])
    assert ("a", 1, "later run") in _rows(snap.current().drop("metadata"))


def test_upsert_reads_the_source_once(spark, tmp_dir):
    for n in ("s", "t"):
        spark.range(5).withColumn("v", F.lit(n)).write.parquet(os.path.join(tmp_dir, n))
    s, t = (spark.read.parquet(os.path.join(tmp_dir, n)) for n in ("s", "t"))
    plan = upsert(t, s, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_late_points_count_in_later_runs(spark, tmp_dir):
    inbox, snap, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "snap", "ckpt"))
    hour = 3600
    runs = [[(0, 1.0), (10 * hour, 2.0)], [(60, 3.0)], [(120, 4.0), (5 * hour, 5.0)], [(180, 6.0)]]
    for points in runs:
        (spark.createDataFrame([(1, s, v) for s, v in points], "id long, s long, value double")
         .select("id", F.timestamp_seconds("s").alias("ts"), "value").coalesce(1).write.mode("append").parquet(inbox))
        stream = spark.readStream.schema("id long, ts timestamp, value double").parquet(inbox)
        out = hourly_rollup_snapshot(spark, stream, snap, ckpt)
    assert _rows(out.select((F.col("hour") / 3600000).cast("int"), "count", "sum")) == [(0, 4, 14.0), (10, 1, 2.0), (5, 1, 5.0)]


def test_tree_deeper_than_a_thousand_levels(spark):
    n = 1300
    rows = [(i, i - 1 if i else None) for i in range(n)] + [(5000, 5001), (5001, 5000), (5002, 5001), (6000, 9999), (5003, 5003)]
    got = {r.id: r for r in path_depth_children(spark.createDataFrame(rows, "id long, parent_id long")).collect()}
    assert all(got[i].depth == i and got[i].path == list(range(i + 1)) for i in (0, 1, 999, 1000, 1001, n - 1))
    assert all(got[i].depth is None and got[i].path is None for i in (5000, 5001, 5002, 5003, 6000))


def test_list_filters_are_pushed(spark, tmp_dir):
    path = os.path.join(tmp_dir, "k")
    spark.createDataFrame([("a",), ("b",), (None,)], "k string").write.parquet(path)
    df = spark.read.parquet(path)
    for allow, deny, want in ((["a", "b"], [], 2), (["*"], ["a"], 2), ([], [], 0), (["*"], [], 3), (["a", "b"], ["b"], 1)):
        out = df.filter(allow_deny("k", allow, deny))
        assert out.count() == want
        plan = out._jdf.queryExecution().executedPlan().toString()
        if deny or (allow and allow != ["*"]):
            assert "PushedFilters: []" not in plan and ("In(" in plan or "EqualTo" in plan), plan


def test_wide_rows_are_not_broadcast(spark):
    wide = spark.range(1000).withColumn("x", F.repeat(F.lit("y"), 1000))
    assert not joins.sized_dim(wide, max_bytes=100_000)[1] and joins.sized_dim(wide)[1]


def test_text_lines_are_written_as_they_are(spark, tmp_dir):
    class Src:
        def ts_points(self):
            return spark.createDataFrame([("a|b", 1700000000000, None, 'iso|"1.5" \\ x ')], "external_id string, timestamp long, value double, value_string string")

    out = os.path.join(tmp_dir, "lines")
    jobs.export_points_text(Src(), out, "a|b", single_file=True)
    part, = (f for f in os.listdir(out) if f.startswith("part-"))
    lines = open(os.path.join(out, part)).read().split("\n")
    assert lines[0] == "externalId|timestamp|timestamp_datetime|value"
    assert lines[1].startswith("a|b|1700000000000|") and lines[1].endswith('|iso|"1.5" \\ x ')
