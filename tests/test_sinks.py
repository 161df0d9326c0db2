"""Sink invariants: upsert idempotence, snapshots, delta state, hierarchy re-sync,
partitioned overwrite and text export."""

import glob
import os

from pyspark.sql import functions as F

from assetlake.plans import jobs
from assetlake.plans import replicate as R
from assetlake.plans.params import RUN_MS, RUN_TIME, cfg_assets, cfg_events
from assetlake.sinks.snapshot import SnapshotTable
from assetlake.sinks.upsert import hierarchy_sync, upsert
from assetlake.sources.scan import DeltaState
from assetlake.sources.scan import ParquetTenant, materialize


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_replaces_and_is_idempotent(spark):
    tgt = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v long, w string")
    src = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v long")
    once = upsert(tgt, src, ["k"])
    assert _set(once) == [("a", 1, "x"), ("b", 20, None), ("c", 30, None)]  # whole-row replace
    assert _set(upsert(once, src, ["k"])) == _set(once)


def test_snapshot_versions(spark, tmp_dir):
    snap = SnapshotTable(spark, os.path.join(tmp_dir, "t"))
    assert snap.current() is None
    assert snap.commit(spark.createDataFrame([(1,)], "x long")) == 1
    assert snap.commit(spark.createDataFrame([(2,)], "x long")) == 2
    assert _set(snap.current()) == [(2,)]


def test_delta_slices_equal_full_read(spark, tenants, tmp_dir):
    """Delta publish merged over k runs equals one full read."""
    src, _ = tenants
    state = DeltaState(spark, os.path.join(tmp_dir, "state"))
    snap = SnapshotTable(spark, os.path.join(tmp_dir, "events"))
    events = src.events()
    bounds = [r[0] for r in events.select(F.expr("percentile_approx(last_updated_time, array(0.3, 0.6))"))
              .collect()][0]

    class Slice:
        def __init__(self, hi):
            self.hi = hi

        def events(self):
            return events.filter(F.col("last_updated_time") <= self.hi)

    for hi in bounds + [events.agg(F.max("last_updated_time")).first()[0]]:
        jobs.run_publish_merge("events", Slice(hi), snap, ["id"], RUN_TIME, state)
    full = jobs.PUBLISH["events"](src, RUN_TIME)
    assert _set(snap.current().drop("row_updated_time")) == _set(full.drop("row_updated_time"))
    assert state.read("events") == events.agg(F.max("last_updated_time")).first()[0]


def test_hierarchy_resync_is_unchanged(spark, tenants, tmp_dir):
    src, tgt = tenants
    cfg = cfg_assets()
    prepared = R.prepare_assets(src, tgt, cfg, on_invalid="quarantine")
    synced = hierarchy_sync(prepared, tgt.assets(), RUN_MS)
    path = os.path.join(tmp_dir, "tgt_assets")
    synced.write.parquet(path)

    class NewTarget:
        def __init__(self):
            self.base = tgt

        def assets(self):
            return spark.read.parquet(path)

        def data_sets(self):
            return tgt.data_sets()

    plan = R.plan_hierarchy_sync(src, NewTarget(), cfg, on_invalid="quarantine")
    ops = {r["op"] for r in plan.collect()}
    assert ops == {"unchanged"}


def test_missing_external_id_fails_the_job(spark, tenants):
    import pytest
    src, tgt = tenants
    with pytest.raises(R.MissingKeyError):
        R.prepare_assets(src, tgt, cfg_assets(), on_invalid="fail")


def test_publish_partitioned_overwrite(spark, tenants, tmp_dir):
    src, _ = tenants
    out = os.path.join(tmp_dir, "points")
    jobs.run_publish("ts_points", src, out, RUN_TIME)
    back = spark.read.parquet(out)
    assert "p_date" in back.columns
    assert back.count() == jobs.PUBLISH["ts_points"](src, RUN_TIME).count()


def test_text_export_single_file(spark, tenants, tmp_dir):
    src, _ = tenants
    out = os.path.join(tmp_dir, "export")
    jobs.export_points_text(src, out, "ts:1", single_file=True)
    files = glob.glob(os.path.join(out, "part-*"))
    assert len(files) == 1
    lines = open(files[0]).read().splitlines()
    assert lines[0] == "externalId|timestamp|timestamp_datetime|value"
    assert all(line.startswith("ts:1|") for line in lines[1:]) and len(lines) > 1


def test_replicate_events_runner_updates_snapshot(spark, tenants, tmp_dir):
    src, tgt = tenants
    snap = SnapshotTable(spark, os.path.join(tmp_dir, "tgt_events"))
    state = DeltaState(spark, os.path.join(tmp_dir, "state"))
    jobs.run_replicate_events(src, tgt, snap, cfg_events(), RUN_TIME, state)
    n1 = snap.current().count()
    c = jobs.LAST_COUNTERS["replicate_events"]
    assert c["events"] == R.prepare_events(src, tgt, cfg_events(), RUN_TIME).count()
    assert 0 < c["assets_mapped"] <= c["events"] and 0 < c["constraint_fixed"] < c["events"]
    jobs.run_replicate_events(src, tgt, snap, cfg_events(), RUN_TIME, state)
    assert snap.current().count() == n1  # re-run is idempotent
    assert state.read("events-replication") is not None


def test_materialized_tenant_roundtrip(spark, tenants, tmp_dir):
    src, _ = tenants
    root = os.path.join(tmp_dir, "tenant")
    pt = materialize(src, root, resources=("data_sets", "labels"))
    assert isinstance(pt, ParquetTenant)
    assert _set(pt.labels()) == _set(src.labels())


def test_cli_publish_and_replicate(spark, tenants, tmp_dir):
    from assetlake.__main__ import main
    src, tgt = tenants
    s_root, t_root = os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "t")
    materialize(src, s_root, ("data_sets", "labels", "raw_rows"))
    materialize(tgt, t_root, ("data_sets", "labels"))
    main(["publish", "labels", "--source", s_root, "--out", os.path.join(tmp_dir, "out_labels"),
          "--run-time", RUN_TIME])
    assert spark.read.parquet(os.path.join(tmp_dir, "out_labels")).count() == src.labels().count()
    cfg = os.path.join(tmp_dir, "raw.toml")
    with open(cfg, "w") as fh:
        fh.write('[allowList]\ndbNames = ["geo"]\n[denyList]\ndbNames = []\n')
    main(["replicate", "raw", "--source", s_root, "--target", t_root, "--out", os.path.join(tmp_dir, "raw_snap"),
          "--config", cfg])
    snap = SnapshotTable(spark, os.path.join(tmp_dir, "raw_snap"))
    assert {r[0] for r in snap.current().select("db_name").distinct().collect()} == {"geo"}


def test_replicate_assets_runner(spark, tenants, tmp_dir):
    src, tgt = tenants
    snap = SnapshotTable(spark, os.path.join(tmp_dir, "assets"))
    jobs.run_replicate_assets(src, tgt, snap, cfg_assets(), RUN_MS, on_invalid="quarantine")
    out = snap.current()
    assert out.select("external_id").distinct().count() == out.count()


def test_full_read_query_goes_past_a_stored_mark(spark, monkeypatch):
    from assetlake.plans.params import DELTA_MARK_MS
    from assetlake.plans.registry import queries
    from assetlake.sources.scan import DeltaState as State
    from conftest import SF

    seen, scan = [], State.scan

    def noted(self, df, identifier, offset_ms, full_read=False, **more):
        seen.append((self.read(identifier), full_read, scan(self, df, identifier, offset_ms, **more).count()))
        return scan(self, df, identifier, offset_ms, full_read, **more)

    monkeypatch.setattr(State, "scan", noted)
    rows = queries()["q_full_read_events"](spark, SF).count()
    assert [x[:2] for x in seen] == [(DELTA_MARK_MS, True)] and seen[0][2] < rows
