"""Job runners: scan (with delta state) -> transform -> sink -> commit mark.

These are the 23 jobs of the catalogue as callables. Each reads a source
tenant (and a target tenant for replication), writes its output, and only
then advances its delta high-water mark, so a failed or retried run
re-reads the same rows (at-least-once with idempotent sinks).
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as K
from ..config import JobConfig
from ..operators import filters as flt
from ..operators.metrics import Counters, observe_counters, observed
from ..schemas import PUBLISHED
from ..sinks.partitioned import PartitionedTable
from ..sinks.snapshot import SnapshotTable
from ..sinks.upsert import hierarchy_sync, upsert
from ..sinks.writers import overwrite, write_lines
from ..sources.scan import DeltaState
from . import publish as P
from . import replicate as R

# Delta identifiers and safety overlaps (ms) of the publish jobs.
DELTA = {
    "assets": ("assets", 600000), "events": ("events", 600000), "files": ("files-header", 600000),
    "raw": ("raw", 60000), "relationships": ("relationships", 600000),
    "sequence_headers": ("seq-header", 600000), "ts_headers": ("ts-header", 600000),
}

# Counters of the last run of each job (F13), filled from observed metrics.
LAST_COUNTERS: dict[str, dict[str, int]] = {}

# Published table layout: (partition timestamp column, clustering columns).
LAYOUT = {
    "raw": ("last_updated_time", ["db_name", "table_name", "last_updated_time"]),
    "ts_points": ("timestamp", ["external_id", "id"]),
    "ts_points_hour": ("timestamp", ["external_id", "id"]),
    "assets": (None, ["data_set_id", "root_id"]),
    "events": (None, ["data_set_id", "type", "subtype"]),
    "files": (None, ["data_set_id", "source"]),
    "ts_headers": (None, ["data_set_id"]),
}

PUBLISH = {
    "assets": P.publish_assets, "data_sets": P.publish_data_sets, "events": P.publish_events,
    "files": P.publish_files, "labels": P.publish_labels, "raw": P.publish_raw,
    "relationships": P.publish_relationships, "sequence_columns": P.publish_sequence_columns,
    "sequence_headers": P.publish_sequence_headers, "sequence_rows": P.publish_sequence_rows,
    "sequence_bodies": P.publish_sequence_bodies,
    "ts_headers": P.publish_ts_headers, "ts_points": P.publish_ts_points,
    "ts_points_hour": partial(P.publish_ts_points_hour, neighbours=True),
}


def run_publish(table: str, src, out_path: str, run_time, state: DeltaState | None = None,
                full_read: bool = False) -> DataFrame:
    """Publish one resource table (overwrite), honouring delta state when given.

    With a delta read the table is replaced by the delta only, as in the
    reference (Q8); use ``run_publish_merge`` to keep older rows.
    """
    fn = PUBLISH[table]
    kwargs = {}
    if table in DELTA and state is not None:
        ident, offset = DELTA[table]
        mark = None if full_read else state.read(ident)
        kwargs = {"since_ms": mark, "offset_ms": offset}
    df = fn(src, run_time, **kwargs)
    part, cluster = LAYOUT.get(table, (None, None))
    overwrite(df, out_path, PUBLISHED[table], partition_col=part, cluster_by=cluster)
    if table in DELTA and state is not None:
        written = df.sparkSession.read.parquet(out_path)
        state.commit(DELTA[table][0], written.select(
            F.unix_millis("last_updated_time").alias("last_updated_time")))
    return df


def run_publish_merge(table: str, src, snapshot: SnapshotTable | PartitionedTable, keys: list[str], run_time,
                      state: DeltaState, full_read: bool = False, until=None) -> int:
    """Delta publish that keeps older rows: upsert the delta, bounded above by ``until`` if given, into a snapshot or a
    partitioned table. The new mark is the latest update time among the rows written, observed by the write itself:
    rows that arrive meanwhile are read next time.
    """
    ident, offset = DELTA[table]
    mark = Observation()
    delta = PUBLISH[table](src, run_time, since_ms=None if full_read else state.read(ident), offset_ms=offset)
    if until is not None:
        delta = delta.where(F.col("last_updated_time") <= F.timestamp_millis(F.lit(flt.to_ms(until)).cast("long")))
    delta = delta.observe(mark, F.unix_millis(F.max("last_updated_time")).alias("mark"))
    v = _upsert_into(snapshot, delta, keys)
    state.advance(ident, observed(mark).get("mark"))
    return v


def export_points_text(src, out_path: str, external_id: str, single_file: bool = False,
                       start_ms: int = P.EXPORT_START_MS) -> None:
    """TsPointsToFile: one series as ``externalId|timestamp|timestamp_datetime|value`` lines."""
    lines = P.points_text_lines(src, external_id, start_ms).select("line")
    write_lines(lines, out_path, P.TEXT_HEADER, single_file=single_file)


# ----------------------------------------------------------------- replicate
def run_replicate_events(src, tgt, target: SnapshotTable, cfg: JobConfig, run_time,
                         state: DeltaState | None = None, full_read: bool = False) -> int:
    since = None if (state is None or full_read) else state.read("events-replication")
    mark, counters = Observation("events_mark"), Counters("replicate_events")
    prepared = R.prepare_events(src, tgt, cfg, run_time, since_ms=since, mark=mark, counters=counters)
    prepared, obs = observe_counters(
        prepared, "replicate_events",
        events=F.lit(True), assets_mapped=F.size("asset_ids") > 0,
        data_set_mapped=F.col("data_set_id").isNotNull(),
        constraint_fixed=F.size(F.map_filter("metadata", lambda k, _: k.startswith("constraintViolation"))) > 0)
    v = _upsert_into(target, prepared, ["external_id"])
    LAST_COUNTERS["replicate_events"] = counters.values | observed(obs)
    if state is not None:
        state.advance("events-replication", observed(mark).get("mark"))
    return v


def assert_unique(df: DataFrame, key: str) -> None:
    """Fail when two rows share ``key`` (e.g. a hash id collision)."""
    dup = df.groupBy(key).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"duplicate {key} values")


def _counted(counters: Counters, done: int) -> int:
    """Keep the counters of a job whose write is done."""
    LAST_COUNTERS[counters.job] = counters.values
    return done


def _upsert_into(target: SnapshotTable | PartitionedTable, rows: DataFrame, keys: list[str], unique: bool = False) -> int:
    """The new version of a snapshot, or the number of partitions rewritten."""
    if isinstance(target, PartitionedTable):
        if target.keys != keys:
            raise ValueError(f"the target is keyed on {target.keys}, the job on {keys}")
        return len(target.upsert(rows, unique))
    return target.commit(upsert(target.current(), rows, keys))


def run_replicate_files(src, tgt, target: SnapshotTable, cfg: JobConfig, run_time) -> int:
    """Files with content: upsert keyed on external id (B10); the newest row of a key is chosen before bodies are read."""
    counters = Counters("replicate_files")
    rows = R.prepare_files(src, tgt, cfg, run_time, with_content=True, newest_only=True, counters=counters)
    return _counted(counters, _upsert_into(target, rows, ["external_id"], unique=True))


def run_replicate_files_metadata(src, tgt, target: SnapshotTable, cfg: JobConfig, run_time,
                                 state: DeltaState | None = None, full_read: bool = False) -> int:
    since = None if (state is None or full_read) else state.read("files-metadata-replication")
    mark, counters = Observation("files_mark"), Counters("replicate_files_metadata")
    rows = R.prepare_files(src, tgt, cfg, run_time, with_content=False, since_ms=since, mark=mark, counters=counters)
    v = _counted(counters, _upsert_into(target, rows, ["external_id"]))
    if state is not None:
        state.advance("files-metadata-replication", observed(mark).get("mark"))
    return v


def run_replicate_labels(src, tgt, target: SnapshotTable, cfg: JobConfig, map_data_sets: bool = False) -> int:
    counters = Counters("replicate_labels")
    return _counted(counters, _upsert_into(target, R.prepare_labels(src, tgt, cfg, map_data_sets, counters), ["external_id"]))


def run_replicate_raw(src, target: SnapshotTable, cfg: JobConfig) -> int:
    counters = Counters("replicate_raw")
    return _counted(counters, _upsert_into(target, R.prepare_raw(src, cfg, counters), ["db_name", "table_name", "key"]))


def run_replicate_relationships(src, tgt, target: SnapshotTable, cfg: JobConfig) -> int:
    counters = Counters("replicate_relationships")
    return _counted(counters, _upsert_into(target, R.prepare_relationships(src, tgt, cfg, counters), ["external_id"]))


def run_replicate_sequences(src, tgt, headers_out: SnapshotTable, rows_out: SnapshotTable,
                            cfg: JobConfig) -> tuple[int | None, int | None]:
    """Headers first, rows only after the headers are written."""
    heads = R.filtered_sequence_headers(src, cfg)
    hv = rv = None
    if cfg.flag(K.SEQUENCE_HEADERS):
        counters = Counters("replicate_sequence_headers")
        hv = _counted(counters, _upsert_into(headers_out, R.prepare_sequence_headers(src, tgt, cfg, heads, counters), ["external_id"]))
    if cfg.flag(K.SEQUENCE_ROWS):
        counters = Counters("replicate_sequence_rows")
        rv = _counted(counters, _upsert_into(rows_out, R.prepare_sequence_rows(src, cfg, heads, counters=counters), ["seq_external_id", "row_number"]))
    return hv, rv


def run_replicate_ts(src, tgt, headers_out: SnapshotTable, points_out: SnapshotTable, cfg: JobConfig,
                     run_time) -> tuple[int | None, int | None]:
    """One filtered header set feeding zero, one or two sinks (config-gated)."""
    heads = R.filtered_series(src, cfg)
    hv = pv = None
    if cfg.flag(K.TS_HEADERS):
        counters = Counters("replicate_ts_headers")
        hv = _counted(counters, _upsert_into(headers_out, R.prepare_ts_headers(src, tgt, cfg, heads, counters), ["external_id"]))
    if cfg.flag(K.TS_POINTS):
        counters = Counters("replicate_ts_points")
        pv = _counted(counters, _upsert_into(points_out, R.prepare_ts_points(src, cfg, run_time, heads, counters), ["external_id", "timestamp"]))
    return hv, pv


def run_replicate_assets(src, tgt, target: SnapshotTable, cfg: JobConfig, run_ms: int,
                         on_invalid: str = "fail", quarantine: SnapshotTable | None = None) -> int:
    """Hierarchy synchronisation: the target snapshot becomes equal to the source per root.

    With ``on_invalid="quarantine"`` assets without a key are counted and, if ``quarantine`` is given, stored there with
    the reason; both outputs come from one stored pass over the source.
    """
    checks = Observation("checked_assets")
    checked = R.checked_assets(src, cfg).observe(checks, F.count_if(F.col("reason").isNull()).alias("accepted"),
                                                 F.count_if(F.col("reason").isNotNull()).alias("rejected")).checkpoint()
    if on_invalid == "quarantine" and quarantine is not None:
        quarantine.commit(R.rejected_assets(checked, datetime.fromtimestamp(run_ms / 1000, timezone.utc)))
    counters, ops = Counters("replicate_assets"), Observation("replicate_assets")
    prepared = R.prepare_assets(src, tgt, cfg, on_invalid, checked, counters)
    synced = hierarchy_sync(prepared, tgt.assets(), run_ms, ops).checkpoint()
    LAST_COUNTERS["replicate_assets"] = counters.values | observed(ops) | observed(checks)
    assert_unique(synced, "id")  # new ids are xxhash64(external_id): check for collisions
    return target.commit(synced)
