"""Counters that the replication jobs observe while they write."""

from pyspark.sql import functions as F

from assetlake.plans import jobs
from assetlake.plans import replicate as R
from assetlake.plans.params import RUN_TIME, cfg_raw, cfg_relationships, cfg_sequences, cfg_ts
from assetlake.sinks.partitioned import KeyedTable
from assetlake.sinks.snapshot import SnapshotTable


def test_every_job_counts_its_links(spark, tenants, tmp_dir):
    src, tgt = tenants
    jobs.LAST_COUNTERS.clear()
    snap = lambda n: SnapshotTable(spark, f"{tmp_dir}/{n}")
    jobs.run_replicate_labels(src, tgt, snap("l"), jobs.JobConfig())
    jobs.run_replicate_raw(src, KeyedTable(spark, f"{tmp_dir}/r", ["db_name", "table_name", "key"], 2), cfg_raw(["*"], []))
    jobs.run_replicate_relationships(src, tgt, snap("rel"), cfg_relationships())
    cfg = cfg_sequences()
    cfg.config |= {"sequenceHeaders": "yes", "sequenceRows": "yes"}
    jobs.run_replicate_sequences(src, tgt, snap("h"), snap("rows"), cfg)
    cfg = cfg_ts()
    cfg.config |= {"tsHeaders": "yes", "tsPoints": "yes"}
    jobs.run_replicate_ts(src, tgt, snap("th"), snap("tp"), cfg, RUN_TIME)
    seen = jobs.LAST_COUNTERS
    assert set(seen) == {f"replicate_{n}" for n in ("labels", "raw", "relationships", "sequence_headers", "sequence_rows", "ts_headers", "ts_points")}
    assert seen["replicate_labels"]["read"] == src.labels().count() and seen["replicate_raw"]["read"] == src.raw_rows().count()
    rel = R.prepare_relationships(src, tgt, cfg_relationships())
    n, mapped = rel.count(), rel.where("data_set_id IS NOT NULL").count()
    assert seen["replicate_relationships"] == {"read": n, "data_set_mapped": mapped, "data_set_not_mapped": n - mapped}
    heads, out = R.filtered_series(src, cfg), R.prepare_ts_headers(src, tgt, cfg)
    got = seen["replicate_ts_headers"]
    assert got["missing_external_id"] == heads.where("external_id IS NULL").count() and got["read"] == heads.count()
    assert got["asset_mapped"] == out.where(F.col("asset_id").isNotNull()).count() and got["asset_mapped"] + got["asset_not_mapped"] == got["read"]
    points = R.prepare_ts_points(src, cfg, RUN_TIME)
    assert seen["replicate_ts_points"]["points"] == points.count()
    assert seen["replicate_sequence_rows"]["rows"] == R.prepare_sequence_rows(src, cfg_sequences()).count()
    assert seen["replicate_sequence_headers"]["read"] == R.filtered_sequence_headers(src, cfg_sequences()).count()


def test_jobs_end_when_the_planner_finds_nothing_to_read(spark, tenants, tmp_dir):
    from assetlake.plans.params import cfg_events
    from assetlake.sources.scan import DeltaState
    src, tgt = tenants
    state, cfg = DeltaState(spark, f"{tmp_dir}/state"), cfg_events()
    cfg.allow["dataSetExternalId"] = ["unknown"]
    jobs.run_replicate_events(src, tgt, SnapshotTable(spark, f"{tmp_dir}/e"), cfg, RUN_TIME, state)
    assert jobs.LAST_COUNTERS["replicate_events"]["read"] == 0
    jobs.run_replicate_raw(src, SnapshotTable(spark, f"{tmp_dir}/r"), cfg_raw([], []))
    assert jobs.LAST_COUNTERS["replicate_raw"]["read"] == 0
