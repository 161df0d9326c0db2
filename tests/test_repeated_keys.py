"""Keys that repeat or are NULL: path walk, array remap, hierarchy sync (one join of source and target)."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from assetlake.operators import remap
from assetlake.operators.hierarchy import hierarchy_diff, merge_hierarchy, path_depth_children
from assetlake.plans import jobs
from assetlake.plans import replicate as R
from assetlake.plans.params import RUN_MS, cfg_assets
from assetlake.sinks.snapshot import SnapshotTable
from assetlake.sinks.upsert import hierarchy_sync

ASSET = ("external_id string, name string, parent_external_id string, description string, source string, data_set_id long,"
         "labels array<string>, metadata map<string,string>, root_external_id string")


def asset(ext, name="n", parent=None, root="r", meta=None):
    return (ext, name, parent, None, None, None, [], meta or {}, root)


def test_repeated_asset_ids_give_one_row_each(spark):
    chain = [(k, k - 1 if k else None) for k in range(7)]
    got = path_depth_children(spark.createDataFrame(chain + chain[1:] + [(3, None), (None, 2)], "id long, parent_id long")).collect()
    assert sorted((r.id, r.depth, len(r.path), r.child_count) for r in got) == [(k, k, k + 1, int(k < 6)) for k in range(7)]


def test_arrays_of_repeated_and_null_row_ids(spark):
    rows = [(1, [10]), (1, [20]), (None, [20, 10, 99, 20]), (2, []), (2, None), (3, [None, 10])]
    tr = spark.createDataFrame([(10, 100), (20, 200)], "src_id long, tgt_id long")
    got = remap.remap_array(spark.createDataFrame(rows, "id long, links array<long>"), "id", "links", tr).collect()
    assert sorted(((r.id or 0), r.links) for r in got) == [(0, [200, 100, 200]), (1, [100]), (1, [200]), (2, []), (2, []), (3, [100])]


def target(spark, rows):
    """Target assets with ids; parent and root ids from the external ids."""
    ids = {r[0]: k + 1 for k, r in enumerate(rows) if r[0]}
    full = [(k + 1, *r[:8], ids.get(r[2]), ids.get(r[8]), 5, 6) for k, r in enumerate(rows)]
    ddl = "id long," + ASSET.rsplit(",", 1)[0] + ", parent_id long, root_id long, created_time long, last_updated_time long"
    return spark.createDataFrame(full, ddl)


def test_sync_with_duplicates_null_ids_moves_and_deletes(spark):
    src = spark.createDataFrame([asset("r"), asset("a", "new", "r"), asset("a", "other", "r"), asset("a", "other", "r"), asset("moved", "n", "r"), asset("add", "n", "a")], ASSET)
    tgt = target(spark, [asset("r"), asset("a", "old", "r"), asset("gone", "n", "r"), asset("x", root="x"), asset("moved", "n", "x", "x"), asset("y", "n", "x", "x"),
                         asset(None, "lone", "x", "x"), asset(None, "lone2", "x", "x"), asset(None, "lost", "r")])
    seen = Observation()
    out = {(r.external_id, r.name): r for r in hierarchy_sync(src, tgt, RUN_MS, seen).collect()}
    assert len(out) == 8 and {k[0] for k in out} == {"r", "a", "add", "moved", "x", "y", None}
    assert {k[1] for k in out if k[0] is None} == {"lone", "lone2"}
    by = {r.external_id: r for r in out.values() if r.external_id}
    assert by["a"].id == 2 and by["a"].created_time == 5 and by["a"].last_updated_time == RUN_MS and by["r"].last_updated_time == 6
    assert by["moved"].root_id == by["r"].id and by["add"].parent_id == 2 and by["add"].created_time == RUN_MS
    assert by["y"].root_id == by["x"].id == 4
    assert seen.get == {"create": 1, "update": 2, "delete": 2, "unchanged": 1, "outside": 4, "source_duplicates": 2, "target_duplicates": 0}


def test_duplicates_on_both_sides_meet_once(spark):
    src = spark.createDataFrame([asset("r")] + [asset("a", f"v{k}") for k in range(5)], ASSET)
    tgt = spark.createDataFrame([asset("r")] + [asset("a", f"w{k}") for k in range(7)], ASSET)
    got = {r.external_id: (r.op, r.s_n, r.t_n) for r in merge_hierarchy(src, tgt).collect()}
    assert got == {"r": ("unchanged", 1, 1), "a": ("update", 5, 7)}
    assert hierarchy_diff(src, tgt).count() == 2


def test_one_join_of_source_and_target(spark):
    src, tgt = spark.createDataFrame([asset("r")], ASSET).checkpoint(), spark.createDataFrame([asset("r")], ASSET).checkpoint()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merge_hierarchy(src, tgt)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning(external_id") == 2


def test_assets_job_twice_reports_counters(spark, tenants, tmp_dir):
    src, tgt = tenants
    snap = SnapshotTable(spark, f"{tmp_dir}/assets")
    jobs.run_replicate_assets(src, tgt, snap, cfg_assets(), RUN_MS, on_invalid="quarantine")
    first = jobs.LAST_COUNTERS["replicate_assets"]
    plan = {r["op"]: r["count"] for r in R.plan_hierarchy_sync(src, tgt, cfg_assets(), on_invalid="quarantine").groupBy("op").count().collect()}
    assert {k: v for k, v in first.items() if k in plan} == plan

    class Again:
        def assets(self):
            return snap.current()

        def data_sets(self):
            return tgt.data_sets()
    jobs.run_replicate_assets(src, Again(), snap, cfg_assets(), RUN_MS + 1, on_invalid="quarantine")
    again = jobs.LAST_COUNTERS["replicate_assets"]
    assert again["create"] == again["update"] == again["delete"] == again["source_duplicates"] == 0
    assert again["unchanged"] == sum(first[k] for k in ("create", "update", "unchanged"))
    assert snap.current().where(F.col("last_updated_time") > RUN_MS).count() == 0
