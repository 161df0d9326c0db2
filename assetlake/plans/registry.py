"""Registered queries: one per operator group of the survey (Spark side).

Every query derives the source/target tenants from the driver tables of
``sf_dir`` and runs a job (or one operator of it) over the whole tables,
returning the comparison form of its result (see ``compare.py``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.scalars import clamp_value, dynamic_text, ext_id_fallback, put_metadata
from ..operators import filters as flt
from ..operators import remap
from ..operators.batching import batch_rows
from ..operators.hierarchy import path_depth_children
from ..operators.metrics import run_counters
from ..operators.nested import last_record
from ..operators.rules import cap_event_end, clean_file_names, event_rules
from ..operators.timeseries import hourly_aggregates
from ..session import scratch_dir
from ..sinks.partitioned import DayTable, KeyedTable
from ..sinks.snapshot import SnapshotTable
from ..sinks.upsert import hierarchy_sync, upsert
from ..sources.derived import DerivedTenant
from ..sources.scan import DeltaState, upper_bound
from ..sources.tables import Tables
from . import jobs
from . import publish as P
from . import replicate as R
from .compare import for_compare
from .params import (DELTA_MARK_MS, DELTA_OFFSET_MS, EXPORT_SERIES, FILL_GAP_MS, LONG_ALLOW, LONG_DENY, RUN_MS, RUN_TIME, cfg_assets, cfg_events, cfg_files,
                     cfg_raw, cfg_relationships, cfg_sequences, cfg_ts)


def prepare_session(spark: SparkSession) -> None:
    """What the jobs rely on, whatever session calls them: UTC for epoch-millis
    conversions, and a checkpoint folder (the session's own when it has one)."""
    from ..session import ensure_checkpoint_dir
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)


def tenants(spark: SparkSession, sf_dir: str) -> tuple[DerivedTenant, DerivedTenant]:
    prepare_session(spark)
    t = Tables(spark, sf_dir)
    return DerivedTenant(t, "source"), DerivedTenant(t, "target")


def _q(fn: Callable[[DerivedTenant, DerivedTenant], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src, tgt = tenants(spark, sf_dir)
        return for_compare(fn(src, tgt))
    run.__doc__ = fn.__doc__
    return run


def _raw_text(df: DataFrame) -> DataFrame:
    cells = F.transform(F.map_entries("columns"), lambda e: F.struct(e["key"].alias("key"),
                                                                     dynamic_text(e["value"]).alias("value")))
    return df.select("db_name", "table_name", "key", "last_updated_time", cells.alias("columns"))


def _all_history_points(src):
    heads = src.ts_headers().filter(~F.col("is_string")).select("id", "is_step")
    return src.ts_points().filter(F.col("value").isNotNull()).join(heads, "id")


def _clamp_input(src):
    e = src.t("events")
    eid = F.col("event_id")
    v = (F.when(eid % 101 == 0, F.lit(float("nan"))).when(eid % 103 == 0, F.lit(float("inf")))
         .when(eid % 107 == 0, F.lit(float("-inf")))
         .otherwise(F.col("value") * 1e99 * F.when(eid % 2 == 1, F.lit(-1.0)).otherwise(F.lit(1.0))))
    return e.select(eid.alias("id"), v.alias("value"))


def _target_points(src):
    pts = src.ts_points()
    return pts.filter(F.col("timestamp") % 2 == 0).select(
        ext_id_fallback("external_id", "id").alias("external_id"), "timestamp",
        (F.col("value") * 2).alias("value"), "value_string")


def _long_lists(ev: DataFrame) -> DataFrame:
    listed = flt.allow_deny_frame(ev, "external_id", LONG_ALLOW, LONG_DENY)
    every = flt.allow_deny_frame(ev, "external_id", ["*"], LONG_DENY)
    return listed.select(F.lit("listed").alias("rule"), "id").unionByName(every.select(F.lit("every").alias("rule"), "id"))


def _accepted_and_rejected(checked: DataFrame) -> DataFrame:
    kept = checked.where("reason IS NULL").select("id", F.lit("accepted").alias("state"), F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(R.rejected_assets(checked, RUN_TIME).select("id", F.lit("rejected").alias("state"), "reason"))


def _job_counters(src, tgt) -> DataFrame:
    """The counters of ``q_run_counters`` as three jobs observe them while they write."""
    spark = src.events().sparkSession
    into = lambda name: SnapshotTable(spark, scratch_dir(spark, f"{name}-{uuid.uuid4().hex}"))
    jobs.run_replicate_events(src, tgt, into("counted-events"), cfg_events(), None)
    jobs.run_replicate_files(src, tgt, into("counted-files"), cfg_files(), None)
    jobs.run_replicate_assets(src, tgt, into("counted-assets"), cfg_assets(), RUN_MS, "quarantine")
    seen = {f"{job}_{k}": v for job in ("events", "files", "assets") for k, v in jobs.LAST_COUNTERS[f"replicate_{job}"].items()}
    names = ["events_missing_external_id", "events_assets_mapped", "events_data_set_mapped", "events_data_set_not_mapped", "assets_root",
             "files_forward_slash", "files_back_slash", "files_cleaned", "files_labels_removed"]
    return spark.createDataFrame([(n, seen[n]) for n in names], "counter string, value long")


def _written(src, table: str) -> DataFrame:
    """A table as it is read back after its publish job, written over an older one."""
    spark = src.events().sparkSession
    out = scratch_dir(spark, f"published-{table}-{uuid.uuid4().hex}")
    spark.range(1).write.parquet(out)
    jobs.run_publish(table, src, out, RUN_TIME)
    return spark.read.parquet(out)


def _text_export(src) -> DataFrame:
    """The lines of one series from an instant within it, read back as text."""
    spark = src.events().sparkSession
    out = scratch_dir(spark, f"text-export-{uuid.uuid4().hex}")
    jobs.export_points_text(src, out, EXPORT_SERIES, start_ms=DELTA_MARK_MS)
    return spark.read.option("pathGlobFilter", "*.txt").text(out).where(F.col("value") != P.TEXT_HEADER).select(F.col("value").alias("line"))


def _sequences_job(src, tgt) -> DataFrame:
    """Sequence rows of the job that writes headers first; the second run replaces them."""
    spark, cfg = src.events().sparkSession, cfg_sequences()
    cfg.config |= {"sequenceHeaders": "yes", "sequenceRows": "Yes"}
    rows = KeyedTable(spark, scratch_dir(spark, f"sequence-rows-{uuid.uuid4().hex}"), ["seq_external_id", "row_number"], 8)
    heads = KeyedTable(spark, scratch_dir(spark, f"sequence-heads-{uuid.uuid4().hex}"), ["external_id"], 4)
    for _ in range(2):
        jobs.run_replicate_sequences(src, tgt, heads, rows, cfg)
    known = heads.current().select(F.col("external_id").alias("seq_external_id"))
    return rows.current().join(known, "seq_external_id", "left_semi").select(
        "seq_external_id", "row_number", F.array_join(F.transform("values", lambda v: P.cell_text(v)), ",").alias("values"))


def _ts_job_flags(src, tgt) -> DataFrame:
    """What the series job writes under each setting of its two flags (-1: not written)."""
    spark, out = src.events().sparkSession, []
    for heads, points in (("no", "yes"), ("YES", "no"), ("maybe", "")):
        cfg = cfg_ts()
        cfg.config |= {"tsHeaders": heads, "tsPoints": points}
        to = [SnapshotTable(spark, scratch_dir(spark, f"ts-{k}-{uuid.uuid4().hex}")) for k in "hp"]
        jobs.run_replicate_ts(src, tgt, *to, cfg, RUN_TIME)
        out.append((heads, *(-1 if x.current() is None else x.current().count() for x in to)))
    return spark.createDataFrame(out, "setting string, n_headers long, n_points long")


def _files_job(src, tgt) -> DataFrame:
    """Files with bodies as they are read back after two runs of their job."""
    spark = src.events().sparkSession
    out = KeyedTable(spark, scratch_dir(spark, f"files-{uuid.uuid4().hex}"), ["external_id"], 8)
    for _ in range(2):
        jobs.run_replicate_files(src, tgt, out, cfg_files(), RUN_TIME)
    return out.current().withColumn("content", F.md5("content"))


def _through(table, first: DataFrame, then: DataFrame) -> DataFrame:
    """The stored rows after ``first`` and ``then`` were upserted into ``table``."""
    table.upsert(first)
    table.upsert(then)
    return table.stored()


def _scratch(df: DataFrame, name: str) -> str:
    return scratch_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex}")


def _points_by_day(src) -> DataFrame:
    old = _target_points(src)
    return _through(DayTable(old.sparkSession, _scratch(old, "points-by-day")), old, R.prepare_ts_points(src, cfg_ts(), RUN_TIME)).select(
        "external_id", "timestamp", "value", "value_string", F.col("p_date").cast("string").alias("p_date"))


def _events_by_key(src, tgt) -> DataFrame:
    old = tgt.events()
    table = KeyedTable(old.sparkSession, _scratch(old, "events-by-key"), ["external_id"], 16)
    return _through(table, old, R.prepare_events(src, tgt, cfg_events(), RUN_TIME, since_ms=DELTA_MARK_MS)).drop(table.part)


Q: dict[str, Callable[[DerivedTenant, DerivedTenant], DataFrame]] = {
    # ---------------------------------------------------------------- publish
    "q_publish_assets": lambda s, t: P.publish_assets(s, RUN_TIME),
    "q_publish_data_sets": lambda s, t: P.publish_data_sets(s, RUN_TIME),
    "q_publish_events": lambda s, t: P.publish_events(s, RUN_TIME),
    "q_publish_files": lambda s, t: P.publish_files(s, RUN_TIME),
    "q_publish_labels": lambda s, t: P.publish_labels(s, RUN_TIME),
    "q_publish_raw": lambda s, t: P.publish_raw(s, RUN_TIME),
    "q_publish_relationships": lambda s, t: P.publish_relationships(s, RUN_TIME),
    "q_publish_sequence_columns": lambda s, t: P.publish_sequence_columns(s, RUN_TIME),
    "q_publish_sequence_headers": lambda s, t: P.publish_sequence_headers(s, RUN_TIME),
    "q_publish_sequence_rows": lambda s, t: P.publish_sequence_rows(s, RUN_TIME),
    "q_publish_sequence_bodies": lambda s, t: P.publish_sequence_bodies(s, RUN_TIME),
    "q_sequence_last_record": lambda s, t: last_record(s.sequence_body()),
    "q_publish_ts_headers": lambda s, t: P.publish_ts_headers(s, RUN_TIME),
    "q_publish_ts_points": lambda s, t: P.publish_ts_points(s, RUN_TIME),
    "q_publish_ts_points_hour": lambda s, t: P.publish_ts_points_hour(s, RUN_TIME, neighbours=True),
    # ------------------------------------------------------------ scans (A*)
    "q_asset_path_depth_children": lambda s, t: path_depth_children(s.assets()),
    "q_raw_catalog": lambda s, t: P.raw_catalog(s),
    "q_delta_events": lambda s, t: P.publish_events(s, RUN_TIME, since_ms=DELTA_MARK_MS,
                                                    offset_ms=DELTA_OFFSET_MS),
    "q_full_read_events": lambda s, t: P.publish_events(
        _FullRead(s, RUN_MS), RUN_TIME),
    # ---------------------------------------------------------- filters (D*)
    "q_filter_root_allow_deny": lambda s, t: R.prepare_assets(s, t, cfg_assets(), on_invalid="quarantine"),
    "q_filter_long_lists": lambda s, t: _long_lists(s.events().select("id", "external_id")),
    "q_asset_quarantine": lambda s, t: _accepted_and_rejected(R.checked_assets(s, cfg_assets()).checkpoint()),
    "q_filter_raw_db": lambda s, t: _raw_text(R.prepare_raw(s, cfg_raw(["geo", "sales"], ["sales"]))),
    "q_filter_sequences": lambda s, t: R.filtered_sequence_headers(s, cfg_sequences()).select("id", "external_id"),
    "q_filter_ts_regex": lambda s, t: R.filtered_series(s, cfg_ts()).select("id", "external_id"),
    "q_filter_data_set": lambda s, t: flt.data_set_filter(
        s.events(), s.data_sets(), ["ds:ASIA", "ds:EUROPE"]).select("id", "data_set_id"),
    "q_filter_ts_security": lambda s, t: P.publishable_series(s, numeric_only=True).select("id", "name", "is_string"),
    "q_window_hour": lambda s, t: s.ts_points().filter(
        flt.in_window("timestamp", flt.window_previous_hour(RUN_TIME))).select("id", "timestamp"),
    "q_window_days": lambda s, t: s.ts_points().filter(
        flt.in_window("timestamp", flt.window_last_days(RUN_TIME, 4))).select("id", "timestamp"),
    "q_window_config_full": lambda s, t: s.ts_points().filter(
        flt.in_window("timestamp", flt.window_config_days(RUN_TIME, -1))).select("id", "timestamp"),
    # ------------------------------------------------------------ joins (E*)
    "q_id_maps": lambda s, t: remap.translation(s.assets(), t.assets()),
    "q_remap_data_set": lambda s, t: remap.remap_scalar(
        s.events().select("id", "data_set_id"), "data_set_id", remap.translation(s.data_sets(), t.data_sets())),
    "q_remap_scalar_asset": lambda s, t: remap.remap_scalar(
        s.ts_headers().select("id", "asset_id"), "asset_id", remap.translation(s.assets(), t.assets())),
    "q_remap_array_asset": lambda s, t: remap.remap_array(
        s.events().select("id", "asset_ids"), "id", "asset_ids", remap.translation(s.assets(), t.assets())),
    "q_parent_root_external": lambda s, t: remap.parent_and_root_ext(
        s.assets().select("id", "parent_id", "root_id"), remap.id_to_ext(s.assets())),
    "q_valid_labels": lambda s, t: remap.keep_known(s.files().select("id", "labels"), "id", "labels", t.labels()),
    "q_ext_id_fallback": lambda s, t: (
        s.events().select(F.lit("event").alias("kind"), "id", ext_id_fallback("external_id", "id").alias("external_id"))
        .unionByName(s.ts_headers().select(F.lit("series").alias("kind"), "id",
                                           ext_id_fallback("external_id", "id").alias("external_id")))
        .unionByName(s.sequence_headers().select(F.lit("sequence").alias("kind"), "id",
                                                 ext_id_fallback("external_id", "id").alias("external_id")))
        .unionByName(s.files().select(F.lit("file").alias("kind"), "id",
                                      ext_id_fallback("external_id", "id").alias("external_id")))),
    # ----------------------------------------------------- aggregations (F*)
    "q_hour_basic": lambda s, t: hourly_aggregates(_all_history_points(s)).select(
        "id", "hour", "average", "max", "min", "count", "sum", "discrete_variance"),
    "q_hour_continuous": lambda s, t: hourly_aggregates(_all_history_points(s)).select(
        "id", "hour", "interpolation", "step_interpolation", "continuous_variance", "total_variation"),
    "q_hour_filled": lambda s, t: hourly_aggregates(_all_history_points(s), fill_empty=True, max_gap_ms=FILL_GAP_MS).select(
        "id", "external_id", "hour", "average", "count", "interpolation", "step_interpolation", "continuous_variance", "total_variation"),
    "q_batches": lambda s, t: batch_rows(s.ts_headers().select("id"), F.pmod(F.col("id"), F.lit(20)), "id", 20)
    .select("bucket", "batch", F.size("items").cast("long").alias("n_items"),
            F.element_at("items", 1).alias("first_id"), F.element_at("items", -1).alias("last_id")),
    # -------------------------------------------------- rules / scalars (K*)
    "q_event_rules": lambda s, t: event_rules(s.events()).select(
        "id", "start_time", "end_time", "description", "metadata"),
    "q_event_end_cap": lambda s, t: cap_event_end(s.events()).select("id", "end_time"),
    "q_clamp_points": lambda s, t: _clamp_input(s).select("id", clamp_value("value").alias("value")),
    "q_clean_file_names": lambda s, t: clean_file_names(s.files()).select("id", "name", "metadata"),
    "q_metadata_put": lambda s, t: s.events().select(
        "id", put_metadata("metadata", "type", F.coalesce(F.col("type"), F.lit(""))).alias("metadata")),
    "q_text_lines": lambda s, t: P.points_text_lines(s, None),
    # ----------------------------------------------------------- replicate
    "q_replicate_events": lambda s, t: R.prepare_events(s, t, cfg_events(), RUN_TIME),
    "q_replicate_files": lambda s, t: R.prepare_files(s, t, cfg_files(), RUN_TIME).withColumn(
        "content", F.md5("content")),
    "q_replicate_files_metadata": lambda s, t: R.prepare_files(
        s, t, cfg_files(), RUN_TIME, with_content=False, since_ms=DELTA_MARK_MS),
    "q_replicate_labels": lambda s, t: R.prepare_labels(s, t, JobConfig()),
    "q_replicate_raw": lambda s, t: _raw_text(R.prepare_raw(s, cfg_raw(["*"], []))),
    "q_replicate_relationships": lambda s, t: R.prepare_relationships(s, t, cfg_relationships()),
    "q_replicate_sequence_headers": lambda s, t: R.prepare_sequence_headers(s, t, cfg_sequences()).withColumn(
        "columns", F.transform("columns", lambda c: F.struct(
            c["name"].alias("name"), c["external_id"].alias("external_id"),
            c["description"].alias("description"), c["value_type"].alias("value_type")))),
    "q_replicate_sequence_rows": lambda s, t: R.prepare_sequence_rows(s, cfg_sequences()).select(
        "seq_external_id", "row_number",
        F.array_join(F.transform("values", lambda v: P.cell_text(v)), ",").alias("values")),
    "q_replicate_ts_headers": lambda s, t: R.prepare_ts_headers(s, t, cfg_ts()),
    "q_replicate_ts_points": lambda s, t: R.prepare_ts_points(s, cfg_ts(), RUN_TIME),
    # --------------------------------------------------------------- sinks
    "q_upsert_events": lambda s, t: upsert(
        t.events(), R.prepare_events(s, t, cfg_events(), RUN_TIME, since_ms=DELTA_MARK_MS), ["external_id"]),
    "q_upsert_points": lambda s, t: upsert(
        _target_points(s), R.prepare_ts_points(s, cfg_ts(), RUN_TIME), ["external_id", "timestamp"]),
    "q_points_by_day": lambda s, t: _points_by_day(s),
    "q_events_by_key": lambda s, t: _events_by_key(s, t),
    "q_upsert_raw": lambda s, t: _raw_text(upsert(
        t.raw_rows(), R.prepare_raw(s, cfg_raw(["sales"], [])), ["db_name", "table_name", "key"])),
    "q_hierarchy_diff": lambda s, t: R.plan_hierarchy_sync(s, t, cfg_assets(), on_invalid="quarantine"),
    "q_hierarchy_sync": lambda s, t: hierarchy_sync(
        R.prepare_assets(s, t, cfg_assets(), on_invalid="quarantine"), t.assets(), RUN_MS).select(
        "external_id", "name", "parent_external_id", "root_external_id", "description", "data_set_id", "labels",
        "metadata", "created_time", "last_updated_time",
        (F.col("parent_external_id").isNull() | F.col("parent_id").isNotNull()).alias("parent_resolved"),
        F.col("root_id").isNotNull().alias("root_resolved")),
    "q_written_events": lambda s, t: _written(s, "events"),
    "q_written_points": lambda s, t: _written(s, "ts_points").withColumn("p_date", F.col("p_date").cast("string")),
    "q_written_sequence_bodies": lambda s, t: _written(s, "sequence_bodies"),
    "q_text_export": lambda s, t: _text_export(s),
    "q_sequences_job": lambda s, t: _sequences_job(s, t),
    "q_ts_job_flags": lambda s, t: _ts_job_flags(s, t),
    "q_files_job": lambda s, t: _files_job(s, t),
    "q_job_counters": lambda s, t: _job_counters(s, t),
    "q_run_counters": lambda s, t: run_counters(s, t, cfg_events()),
}


class _FullRead:
    """Source view whose events are read in full despite a stored mark, bounded above by the run time (A18 + A19)."""

    def __init__(self, src, until_ms: int):
        self._src, self._until = src, until_ms

    def events(self):
        df = self._src.events()
        spark = df.sparkSession
        state = DeltaState(spark, scratch_dir(spark, f"full-read-{uuid.uuid4().hex}"))
        state.commit("events", spark.createDataFrame([(DELTA_MARK_MS,)], "last_updated_time long"))
        return upper_bound(state.scan(df, "events", DELTA_OFFSET_MS, full_read=True), self._until)


def q_stream_hour_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2-F7 as a Structured Streaming job: the events table read by the file
    stream source, mapped to numeric series points (stream-static join with
    the series headers), rolled up per series and hour and merged
    per micro-batch into a snapshot in the shared checkpoint folder."""
    import uuid

    from ..session import scratch_dir
    from ..streaming.delta_publish import hourly_rollup_snapshot
    prepare_session(spark)
    tables = Tables(spark, sf_dir)
    src = DerivedTenant(tables, "source")
    schema = spark.read.parquet(tables.path("events")).schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    numeric = src.ts_headers().filter(~F.col("is_string")).select("id")
    points = (events.select((F.lit(7000000) + F.col("user_id")).alias("id"), F.col("ts").cast("timestamp").alias("ts"),
                            "value")
              .join(numeric, "id", "left_semi"))
    run = scratch_dir(spark, f"stream-hour-rollup-{uuid.uuid4().hex}")
    out = hourly_rollup_snapshot(spark, points, f"{run}/snapshot", f"{run}/checkpoint")
    return for_compare(out.select("id", "hour", "count", "min", "max", "sum", "average"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _q(fn) for name, fn in Q.items()}
    out["q_stream_hour_rollup"] = q_stream_hour_rollup
    return out


__all__ = ["queries", "tenants"]
