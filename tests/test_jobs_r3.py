"""Delta marks, staged replacement, quarantine and long lists."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from assetlake.operators import filters as flt
from assetlake.operators import joins
from assetlake.plans import jobs
from assetlake.plans import replicate as R
from assetlake.plans.params import RUN_MS, RUN_TIME, cfg_assets, cfg_events, cfg_files
from assetlake.sinks.partitioned import KeyedTable, replace_table
from assetlake.sinks.snapshot import SnapshotTable
from assetlake.sinks.writers import write_lines
from assetlake.sources.scan import DeltaState, ParquetTenant, materialize


def test_rows_that_arrive_between_write_and_mark_are_read_next_time(spark, tenants, tmp_dir):
    src, _ = tenants
    path = f"{tmp_dir}/s"
    early = src.events().where(F.col("last_updated_time") <= RUN_MS).orderBy("last_updated_time").limit(200).checkpoint()
    top = early.agg(F.max("last_updated_time")).first()[0]
    early.write.parquet(f"{path}/events")
    stored, state = ParquetTenant(spark, path), DeltaState(spark, f"{tmp_dir}/state")
    table = KeyedTable(spark, f"{tmp_dir}/events", ["id"], 4)
    upsert = table.upsert

    def late(rows, unique=False):  # a newer row lands while the job writes
        done = upsert(rows, unique)
        early.limit(1).withColumn("id", F.lit(-1).cast("long")).withColumn("last_updated_time", F.lit(top + 1)).write.mode("append").parquet(f"{path}/events")
        return done

    table.upsert = late
    jobs.run_publish_merge("events", stored, table, ["id"], RUN_TIME, state, until=RUN_TIME)
    assert state.read("events") == top and table.current().count() == 200
    table.upsert = upsert
    jobs.run_publish_merge("events", stored, table, ["id"], RUN_TIME, state, until=RUN_TIME)
    assert state.read("events") == top + 1 and table.current().where("id = -1").count() == 1 and table.current().count() == 201
    # rows from after the run time wait for a later run
    early.limit(1).withColumn("id", F.lit(-2).cast("long")).withColumn("last_updated_time", F.lit(RUN_MS + 5)).write.mode("append").parquet(f"{path}/events")
    jobs.run_publish_merge("events", stored, table, ["id"], RUN_TIME, state, until=RUN_TIME)
    assert state.read("events") == top + 1 and table.current().count() == 201
    jobs.run_publish_merge("events", stored, table, ["id"], RUN_TIME, state, full_read=True, until=RUN_TIME)
    assert table.current().count() == 201


def test_replication_marks_are_observed_by_the_job(spark, tenants, tmp_dir):
    src, tgt = tenants
    state = DeltaState(spark, f"{tmp_dir}/state")
    for _ in range(2):
        jobs.run_replicate_events(src, tgt, SnapshotTable(spark, f"{tmp_dir}/e"), cfg_events(), RUN_TIME, state)
        jobs.run_replicate_files_metadata(src, tgt, SnapshotTable(spark, f"{tmp_dir}/f"), cfg_files(), RUN_TIME, state)
        for ident, df in (("events-replication", src.events()), ("files-metadata-replication", src.files())):
            assert state.read(ident) == df.where(F.col("last_updated_time") <= RUN_MS).agg(F.max("last_updated_time")).first()[0]
    assert state.advance("events-replication", 5) == state.read("events-replication") > 5
    assert state.advance("none", None) is None


def test_a_failed_write_leaves_the_old_table(spark, tenants, tmp_dir):
    src, _ = tenants
    out = f"{tmp_dir}/labels"
    jobs.run_publish("labels", src, out, RUN_TIME)
    old = sorted(map(str, spark.read.parquet(out).collect()))

    class Broken:
        def labels(self):
            return src.labels().withColumn("name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception):
        jobs.run_publish("labels", Broken(), out, RUN_TIME)
    assert sorted(map(str, spark.read.parquet(out).collect())) == old
    jobs.run_publish("labels", src, out, RUN_TIME)
    assert sorted(map(str, spark.read.parquet(out).collect())) == old and os.listdir(tmp_dir) == ["labels"]


@pytest.mark.parametrize("complete", [True, False])
def test_an_interrupted_switch_is_settled(spark, tmp_dir, complete):
    out = f"{tmp_dir}/t"
    spark.range(3).write.parquet(f"{tmp_dir}/_old-t")
    spark.range(5).write.parquet(f"{tmp_dir}/_new-t")
    if not complete:
        os.remove(f"{tmp_dir}/_new-t/_SUCCESS")
    with pytest.raises(ZeroDivisionError):
        replace_table(spark, out, lambda path: 1 / 0)
    assert spark.read.parquet(out).count() == (5 if complete else 3) and os.listdir(tmp_dir) == ["t"]


def test_text_files_carry_their_suffix(spark, tmp_dir):
    write_lines(spark.createDataFrame([("a|1",)], "line string"), f"{tmp_dir}/lines", "x|y")
    assert [open(f).read() for f in glob.glob(f"{tmp_dir}/lines/part-*.txt") if "a|1" in open(f).read()] == ["x|y\na|1\n"]


def test_rejected_assets_are_stored_and_counted(spark, tenants, tmp_dir):
    src, tgt = tenants
    kept = SnapshotTable(spark, f"{tmp_dir}/quarantine")
    jobs.run_replicate_assets(src, tgt, SnapshotTable(spark, f"{tmp_dir}/assets"), cfg_assets(), RUN_MS, "quarantine", kept)
    seen, bad = jobs.LAST_COUNTERS["replicate_assets"], src.assets().where("external_id IS NULL OR root_id IS NULL")
    assert seen["rejected"] == kept.current().count() == bad.count() > 0
    assert seen["accepted"] + seen["rejected"] == src.assets().count()
    assert {(r.id, r.reason, r.run_time) for r in kept.current().collect()} == {(r.id, "no external id", RUN_MS) for r in bad.collect()}
    with pytest.raises(R.MissingKeyError):
        jobs.run_replicate_assets(src, tgt, SnapshotTable(spark, f"{tmp_dir}/other"), cfg_assets(), RUN_MS)
    assert SnapshotTable(spark, f"{tmp_dir}/other").current() is None


@pytest.mark.parametrize("max_rows", [0, 2_000_000])
def test_long_lists_give_what_short_ones_give(spark, monkeypatch, max_rows):
    df = spark.createDataFrame([(k, None if k % 7 == 0 else f"k{k}") for k in range(300)], "id long, k string")
    allow, deny = [f"k{k}" for k in range(0, 200, 2)], [f"k{k}" for k in range(0, 300, 6)] * 2
    want = [sorted(map(str, flt.allow_deny_frame(df, "k", a, d).select("id", "k").collect())) for a, d in ((allow, deny), (["*"], deny), (allow, []))]
    monkeypatch.setattr(flt, "ISIN_MAX", 3)
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", max_rows)
    got = [sorted(map(str, flt.allow_deny_frame(df, "k", a, d).select("id", "k").collect())) for a, d in ((allow, deny), (["*"], deny), (allow, []))]
    assert got == want
    plan = flt.allow_deny_frame(df, "k", ["*"], deny)._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == bool(max_rows)


def test_jobs_take_long_lists(spark, tenants, monkeypatch):
    src, tgt = tenants
    want = sorted(map(str, R.prepare_assets(src, tgt, cfg_assets(), "quarantine").collect()))
    monkeypatch.setattr(flt, "ISIN_MAX", 0)
    assert sorted(map(str, R.prepare_assets(src, tgt, cfg_assets(), "quarantine").collect())) == want


def test_stored_tenant_keeps_its_content_dir(spark, tenants, tmp_dir):
    assert materialize(tenants[0], f"{tmp_dir}/t", ("labels",)).content_dir is None


def test_command_line_merges_and_writes_buckets(spark, tenants, tmp_dir):
    from assetlake.__main__ import main
    src, tgt = tenants
    s, t = f"{tmp_dir}/s", f"{tmp_dir}/t"
    materialize(src, s, ("events", "assets", "data_sets", "raw_rows", "sequence_headers", "sequence_rows", "ts_headers", "ts_points", "relationships", "labels"))
    materialize(tgt, t, ("assets", "data_sets", "labels"))
    run = ["--run-time", RUN_TIME, "--state", f"{tmp_dir}/state"]
    for _ in range(2):
        main(["publish", "events", "--source", s, "--out", f"{tmp_dir}/pub", "--merge", "id", *run])
    bounded = src.events().where(F.col("last_updated_time") <= RUN_MS).count()
    assert KeyedTable(spark, f"{tmp_dir}/pub", ["id"]).current().count() == bounded
    with pytest.raises(SystemExit):
        main(["publish", "labels", "--source", s, "--out", f"{tmp_dir}/x", "--merge", "external_id", *run])
    with open(f"{tmp_dir}/c.toml", "w") as fh:
        fh.write('[config]\nsequenceHeaders = "yes"\nsequenceRows = "yes"\ntsHeaders = "no"\ntsPoints = "yes"\n[allowList]\ndataSetExternalId = ["*"]\n'
                 'dbNames = ["*"]\nsequenceExternalId = ["*"]\ntsExternalId = ["*"]\ntsExternalIdRegEx = []\n[denyList]\n')
    again = {}
    for k in range(2):  # every target twice: the second run changes nothing
        for name in ("raw", "relationships", "labels", "sequences", "ts"):
            main(["replicate", name, "--source", s, "--target", t, "--out", f"{tmp_dir}/{name}", "--config", f"{tmp_dir}/c.toml", "--buckets", "2", "--run-time", RUN_TIME])
        found = {p: spark.read.parquet(p).count() for p in sorted(glob.glob(f"{tmp_dir}/*")) if glob.glob(f"{p}/p_*")}
        assert not k or found == again
        again = found
    assert again[f"{tmp_dir}/raw"] == src.raw_rows().count() and again[f"{tmp_dir}/sequences"] == src.sequence_headers().count()
    assert again[f"{tmp_dir}/sequences_rows"] == src.sequence_rows().count() and f"{tmp_dir}/ts" not in again and again[f"{tmp_dir}/ts_points"] > 0
