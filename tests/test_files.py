"""File bodies: found by full path, attached last, never shuffled with the metadata."""

import os

import pytest
from pyspark.sql import functions as F

from assetlake.config import JobConfig
from assetlake.operators import joins
from assetlake.plans import jobs
from assetlake.plans import replicate as R
from assetlake.plans.params import RUN_TIME, cfg_files
from assetlake.sinks.partitioned import KeyedTable
from assetlake.sinks.snapshot import SnapshotTable
from assetlake.sources.files import attach_bodies, files_with_content
from assetlake.sources.scan import ParquetTenant, materialize


def write(root, bodies):
    for path, body in bodies.items():
        os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
        with open(f"{root}/{path}", "wb") as fh:
            fh.write(body)


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_same_names_in_two_folders_stay_apart(spark, tmp_dir, monkeypatch, max_rows):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", max_rows)
    write(f"{tmp_dir}/bodies", {"x/a.txt": b"one", "y/a.txt": b"two", "top.txt": b"", "x/deep er/b%20.txt": b"four", "x/unused": b"z"})
    meta = spark.createDataFrame([(1, "/x", "a.txt"), (2, "y/", "a.txt"), (3, None, "top.txt"), (4, "x/deep er", "b%20.txt"), (5, "x", "c.txt"),
                                  (6, None, None), (7, "x", "a.txt")], "id long, directory string, name string")
    got = {r.id: None if r.content is None else bytes(r.content) for r in files_with_content(spark, meta, f"{tmp_dir}/bodies").collect()}
    assert got == {1: b"one", 2: b"two", 3: None, 4: b"four", 5: None, 6: None, 7: b"one"}  # an empty file has no body


def exchanges_with_content(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    out, lines = [], plan.splitlines()
    for k, line in enumerate(lines):
        if "Exchange" in line:
            depth = line.index("Exchange")
            below = [x for x in lines[k + 1:] if x.strip(" :+-*|")][:1]
            if below and "content" in below[0]:
                out.append((depth, below[0]))
    return out, plan


def test_content_is_in_no_exchange(spark, tenants):
    src, tgt = tenants
    df = R.prepare_files(src, tgt, cfg_files(), RUN_TIME, newest_only=True)
    found, plan = exchanges_with_content(df)
    assert not found and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert df.where("content IS NOT NULL").count() > 0


def test_wide_metadata_meets_bodies_in_one_shuffle(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    files = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "k long, name string")
    bodies = spark.createDataFrame([(1, b"one"), (9, b"z")], "k long, content binary")
    assert sorted((r.name, r.content and bytes(r.content)) for r in attach_bodies(files, bodies, "k").collect()) == [
        ("a", b"one"), ("b", None), ("c", None), ("d", b"one")]


def test_jobs_with_bodies_in_a_folder(spark, tenants, tmp_dir):
    src, tgt = tenants
    materialize(src, f"{tmp_dir}/s", ("data_sets", "assets"))
    files = src.files()
    # a newer row of a key, given twice: the newest one's body stays
    repeated = files.where("id % 10 = 0 AND external_id IS NOT NULL").withColumn("last_updated_time", F.col("last_updated_time") - 1).withColumn("name", F.lit("old"))
    files.drop("content").unionByName(repeated.drop("content")).write.parquet(f"{tmp_dir}/s/files")
    some = files.where("external_id IS NOT NULL AND name LIKE 'page-%'").select("id", "external_id", R.path_key().alias("path")).limit(30).collect()
    write(f"{tmp_dir}/bodies", {r.path: f"body {r.id}".encode() for r in some})
    stored = ParquetTenant(spark, f"{tmp_dir}/s", f"{tmp_dir}/bodies")
    cfg = JobConfig()
    snap, keyed = SnapshotTable(spark, f"{tmp_dir}/snap"), KeyedTable(spark, f"{tmp_dir}/keyed", ["external_id"], 4)
    for out in (snap, keyed, snap, keyed):
        jobs.run_replicate_files(stored, tgt, out, cfg, RUN_TIME)
    for out in (snap.current(), keyed.current()):
        assert out.count() == out.select("external_id").distinct().count()
        assert out.where("name = 'old'").count() == 0
        got = {r.external_id: bytes(r.content) for r in out.where("content IS NOT NULL").collect()}
        paths = {r.path for r in some}
        assert {r.external_id: f"body {r.id}".encode() for r in some if len(paths) == len(some)}.items() <= got.items()
