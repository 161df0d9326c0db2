"""Partition-wise tables: only touched partitions change, the target doesn't move, failed and interrupted writes."""

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from assetlake.operators import joins
from assetlake.plans import jobs
from assetlake.plans.params import RUN_TIME, cfg_events, cfg_ts
from assetlake.sinks.partitioned import READY, DayTable, KeyedTable
from assetlake.sinks.upsert import upsert

DAY = 86_400_000
POINT = "external_id string, timestamp long, value double, value_string string"


def rows(df):
    return sorted(map(str, df.collect()))


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*=*/*.parquet")}


def points(spark, days, value):
    return spark.createDataFrame([(f"s{k}", d * DAY + k, value, None) for d in days for k in range(50)], POINT)


def test_only_touched_days_are_rewritten(spark, tmp_dir):
    path = f"{tmp_dir}/points"
    table = DayTable(spark, path)
    assert table.current() is None
    table.upsert(points(spark, range(10), 1.0))
    before = files(path)
    assert len(glob.glob(f"{path}/p_date=*")) == 10
    delta = points(spark, [3, 4], 2.0).where("timestamp % 2 = 0").unionByName(points(spark, [12], 5.0))
    assert len(table.upsert(delta)) == 3
    after = files(path)
    same = [f for f in before if "p_date=1970-01-04" not in f and "p_date=1970-01-05" not in f]
    assert len(same) < len(before) and all(after.get(f) == before[f] for f in same)
    assert rows(table.current()) == rows(upsert(points(spark, range(10), 1.0), delta, ["external_id", "timestamp"]))
    assert not glob.glob(f"{path}/_pending/*")


@pytest.mark.parametrize("max_rows", [10, 100, 2_000_000])
def test_waves_and_large_partitions_give_the_same(spark, tmp_dir, monkeypatch, max_rows):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", max_rows)
    table, old, new = DayTable(spark, f"{tmp_dir}/p"), points(spark, range(6), 1.0), points(spark, range(2, 8), 2.0).where("timestamp % 3 = 0")
    table.upsert(old)
    table.upsert(new)
    assert rows(table.current()) == rows(upsert(old, new, table.keys))


def test_the_target_does_not_move(spark, tmp_dir):
    table = KeyedTable(spark, f"{tmp_dir}/t", ["k"], 8)
    table.upsert(spark.range(1000).select(F.col("id").cast("string").alias("k"), "id", F.lit("body").alias("body")))
    delta = table.place(spark.createDataFrame([("5", 0, "new"), ("x", 0, "new")], "k string, id long, body string")).checkpoint()
    parts = [r[0] for r in delta.select(table.part).distinct().collect()]
    plan = table.merged(table.stored(), delta, parts, True)._jdf.queryExecution().executedPlan().toString()
    target = plan[plan.index("LeftAnti"):plan.index("FileScan")]  # from the join down to the target's scan
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "BroadcastExchange" not in target.split("\n")[0] and "SortMergeJoin" not in plan
    assert "PartitionFilters: [p_bucket" in plan  # and only touched buckets are read


def test_keyed_table_equals_upsert_and_keeps_its_buckets(spark, tmp_dir):
    ddl = "k string, v long, m map<string,string>, last_updated_time long"
    old = spark.createDataFrame([("a", 1, {"x": "1"}, 1), ("b", 2, None, 5), (None, 3, {"n": "1"}, 1), (None, 4, None, 1)], ddl)
    new = spark.createDataFrame([("b", 20, {"y": None}, 3), ("b", 21, None, 2), ("c", 30, None, None), (None, 3, {"n": "1"}, 1)], ddl)
    table = KeyedTable(spark, f"{tmp_dir}/t", ["k"], 4)
    table.upsert(old)
    for _ in range(2):  # repeating a run adds none, rows without a key included
        table.upsert(new)
        assert rows(table.current()) == rows(upsert(upsert(None, old, ["k"]), new, ["k"]))
    again = KeyedTable(spark, f"{tmp_dir}/t", ["k"], 999)
    assert again.buckets == 4
    again.upsert(spark.createDataFrame([("a", 7, None, 9)], ddl))
    assert again.current().where("k = 'a'").count() == 1
    with pytest.raises(ValueError):
        KeyedTable(spark, f"{tmp_dir}/t", ["v"])
    with pytest.raises(ValueError):
        again.upsert(spark.createDataFrame([("a", 1, 2)], "k string, v long, unknown long"))
    assert again.upsert(new.limit(0)) == []


def test_failed_and_interrupted_writes(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/p"
    table = DayTable(spark, path)
    table.upsert(points(spark, range(3), 1.0))
    old = rows(table.current())
    with pytest.raises(Exception):
        table.upsert(points(spark, [1, 2], 2.0).withColumn("value", F.when(F.col("external_id") != "s7", F.col("value")).otherwise(
            F.raise_error(F.lit("broken")).cast("double"))))
    assert rows(DayTable(spark, path).current()) == old

    moved, move = [], table.folder.move

    def lost(source, target):  # the writer is lost after its first rename
        if moved:
            raise OSError("lost")
        moved.append(target)
        move(source, target)

    monkeypatch.setattr(table.folder, "move", lost)
    with pytest.raises(OSError):
        table.upsert(points(spark, [0, 1, 2], 3.0))
    assert glob.glob(f"{path}/_pending/*/{READY}")
    assert {r.value for r in DayTable(spark, path).current().collect()} == {3.0}
    assert not glob.glob(f"{path}/_pending/*")
    os.makedirs(f"{path}/_pending/left/p_date=1970-01-01")  # never marked ready
    assert DayTable(spark, path).current().count() == 150 and not glob.glob(f"{path}/_pending/*")


def test_points_without_time_have_a_partition(spark, tmp_dir):
    table = DayTable(spark, f"{tmp_dir}/p")
    odd = spark.createDataFrame([("a", None, 1.0, None), ("a", 5, 1.0, None)], POINT)
    table.upsert(odd)
    table.upsert(odd)
    assert table.current().count() == 2


def test_jobs_write_partitioned_targets_twice(spark, tenants, tmp_dir):
    src, tgt = tenants
    day, heads = DayTable(spark, f"{tmp_dir}/points"), KeyedTable(spark, f"{tmp_dir}/heads", ["external_id"], 4)
    events = KeyedTable(spark, f"{tmp_dir}/events", ["external_id"], 8)
    for _ in range(2):
        jobs.run_replicate_ts(src, tgt, heads, day, cfg_ts(), RUN_TIME)
        jobs.run_replicate_events(src, tgt, events, cfg_events(), RUN_TIME)
        assert rows(day.current()) == rows(jobs.R.prepare_ts_points(src, cfg_ts(), RUN_TIME))
        assert heads.current().count() == jobs.R.prepare_ts_headers(src, tgt, cfg_ts()).count()
        assert events.current().count() == jobs.R.prepare_events(src, tgt, cfg_events(), RUN_TIME).count()
    with pytest.raises(ValueError):
        jobs.run_replicate_raw(src, events, jobs.JobConfig())


def test_large_partitions_are_one_wave_and_only_their_keys_are_read(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 10)
    table = DayTable(spark, f"{tmp_dir}/p")
    delta = table.place(points(spark, range(6), 1.0))
    assert [(len(parts), small) for parts, small in table._waves(delta)] == [(6, False)]
    table.upsert(delta.drop(table.part))
    plan = table.merged(table.stored(), table.stored(), [date(1970, 1, 4)], False)._jdf.queryExecution().executedPlan().toString()
    assert any("value" not in line and "timestamp" in line for line in plan.split("\n") if "FileScan" in line or "Scan parquet" in line)


def test_only_keys_that_repeat_are_reduced(spark, tmp_dir):
    ddl = "k string, v long, last_updated_time long"
    rows_ = [(f"k{i}", i, 1) for i in range(50)] + [("k3", 99, 2), (None, 1, 1), (None, 1, 1), (None, 2, 1)]
    given = spark.createDataFrame(rows_, ddl)
    table = KeyedTable(spark, f"{tmp_dir}/t", ["k"], 4)
    assert table._once(table.place(given.where("v < 50 AND k IS NOT NULL"))) is None
    table.upsert(given)
    assert rows(table.current()) == rows(upsert(None, given, ["k"]))
    assert table.current().count() == 52
