"""Publish jobs: one resource type -> one clean analytics table.

Each function returns the output DataFrame with the published schema;
writing it (overwrite, partitioning, clustering) is done by
``assetlake.sinks``. ``run_time`` is a parameter everywhere so that results
are reproducible (it is the ``row_updated_time`` audit value and the "now"
of rolling windows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import cell_text, dynamic_text, iso_instant, map_to_kv, millis_to_ts
from ..operators import filters as flt
from ..operators.hierarchy import path_depth_children
from ..operators.joins import sized_broadcast
from ..operators.nested import records
from ..operators.rules import cap_event_end
from ..operators.timeseries import HOUR_MS, hourly_aggregates
from ..sources.scan import delta_since

# Fixed value: default reserved series-name prefix excluded from publishing.
RESERVED_SERIES_PREFIX = "SYS-"


def _audit(run_time) -> F.Column:
    """K3: the run time as the audit column (a parameter, not the wall clock)."""
    return millis_to_ts(F.lit(flt.to_ms(run_time)).cast("long")).alias("row_updated_time")


def _ts(c: str) -> F.Column:
    return millis_to_ts(c).alias(c)


def _strs(c: str) -> F.Column:
    return F.coalesce(F.col(c), F.array().cast("array<string>")).alias(c)


def _longs(c: str) -> F.Column:
    return F.coalesce(F.col(c), F.array().cast("array<bigint>")).alias(c)


def _kv(c: str = "metadata") -> F.Column:
    return map_to_kv(c).alias(c)


def _maybe_delta(df: DataFrame, since_ms: int | None, offset_ms: int) -> DataFrame:
    return df if since_ms is None else delta_since(df, since_ms, offset_ms)


# --------------------------------------------------------------------- C1
def publish_assets(src, run_time, since_ms: int | None = None, offset_ms: int = 600000) -> DataFrame:
    assets = src.assets()
    agg = path_depth_children(assets)
    df = _maybe_delta(assets, since_ms, offset_ms).join(agg, "id", "left")
    return df.select(
        "id", "external_id", F.coalesce("name", F.lit("")).alias("name"), "parent_id",
        "parent_external_id", "description", "root_id", "source", _ts("created_time"),
        _ts("last_updated_time"), "data_set_id", _strs("labels"), _kv(), "child_count", "depth",
        _longs("path"), _audit(run_time))


# --------------------------------------------------------------------- C2
def publish_data_sets(src, run_time) -> DataFrame:
    return src.data_sets().select(
        "id", "external_id", F.coalesce("name", F.lit("")).alias("name"), "description", _kv(),
        "write_protected", _ts("created_time"), _ts("last_updated_time"), _audit(run_time))


# --------------------------------------------------------------------- C3
def publish_events(src, run_time, since_ms: int | None = None, offset_ms: int = 600000) -> DataFrame:
    df = cap_event_end(_maybe_delta(src.events(), since_ms, offset_ms))
    return df.select(
        "id", "external_id", _ts("start_time"), _ts("end_time"), "description", "type", "subtype",
        "source", _longs("asset_ids"), _ts("created_time"), _ts("last_updated_time"), "data_set_id",
        _kv(), _audit(run_time))


# --------------------------------------------------------------------- C4
def publish_files(src, run_time, since_ms: int | None = None, offset_ms: int = 600000) -> DataFrame:
    df = _maybe_delta(src.files(), since_ms, offset_ms)
    return df.select(
        "id", "external_id", _ts("source_created_time"), _ts("source_modified_time"), "name",
        "directory", "mime_type", "source", _longs("asset_ids"), _longs("security_categories"),
        _strs("labels"), F.coalesce("uploaded", F.lit(False)).alias("uploaded"), _ts("uploaded_time"),
        _ts("created_time"), _ts("last_updated_time"), "data_set_id", _kv(), _audit(run_time))


# --------------------------------------------------------------------- C5
def publish_labels(src, run_time) -> DataFrame:
    return src.labels().select(
        F.coalesce("external_id", F.lit("")).alias("external_id"),
        F.coalesce("name", F.lit("")).alias("name"), "description", "data_set_id",
        _ts("created_time"), _audit(run_time))


# --------------------------------------------------------------------- C6
def publish_raw(src, run_time, since_ms: int | None = None, offset_ms: int = 60000,
                db_names: list[str] | None = None) -> DataFrame:
    """Rows of every raw table, bounded above by the run time."""
    rows = src.raw_rows()
    if db_names is not None:
        rows = rows.filter(F.col("db_name").isin(list(db_names)))
    rows = rows.filter(F.col("last_updated_time") <= F.lit(flt.to_ms(run_time)))
    rows = _maybe_delta(rows, since_ms, offset_ms)
    cols = F.transform(F.map_entries("columns"),
                       lambda e: F.struct(e["key"].alias("key"), dynamic_text(e["value"]).alias("value")))
    return rows.select(
        "db_name", "table_name", F.col("key").alias("row_key"), _ts("last_updated_time"),
        F.coalesce(cols, F.array().cast("array<struct<key:string,value:string>>")).alias("columns"),
        _audit(run_time))


def raw_catalog(src) -> DataFrame:
    """(db_name, table_name) of every raw table."""
    return src.raw_rows().select("db_name", "table_name").distinct()


# --------------------------------------------------------------------- C7
def publish_relationships(src, run_time, since_ms: int | None = None, offset_ms: int = 600000) -> DataFrame:
    df = _maybe_delta(src.relationships(), since_ms, offset_ms)
    return df.select(
        F.coalesce("external_id", F.lit("")).alias("external_id"),
        F.coalesce("source_external_id", F.lit("")).alias("source_external_id"),
        F.coalesce("source_type", F.lit("")).alias("source_type"),
        F.coalesce("target_external_id", F.lit("")).alias("target_external_id"),
        F.coalesce("target_type", F.lit("")).alias("target_type"),
        _ts("start_time"), _ts("end_time"), "confidence", "data_set_id", _strs("labels"),
        _ts("created_time"), _ts("last_updated_time"), _audit(run_time))


# --------------------------------------------------------------------- C8
def publish_sequence_columns(src, run_time) -> DataFrame:
    """One row per column of each sequence."""
    h = src.sequence_headers().select(F.col("external_id").alias("seq_external_id"),
                                      F.explode("columns").alias("c"))
    return h.select(
        F.col("c.name").alias("name"), F.col("c.external_id").alias("external_id"), "seq_external_id",
        F.col("c.description").alias("description"), F.col("c.value_type").alias("value_type"),
        map_to_kv("c.metadata").alias("metadata"),
        millis_to_ts("c.created_time").alias("created_time"),
        millis_to_ts("c.last_updated_time").alias("last_updated_time"), _audit(run_time))


# --------------------------------------------------------------------- C9
def publish_sequence_headers(src, run_time, since_ms: int | None = None, offset_ms: int = 600000) -> DataFrame:
    df = _maybe_delta(src.sequence_headers(), since_ms, offset_ms)
    cols = F.transform("columns", lambda c: F.struct(c["name"].alias("name"), c["external_id"].alias("external_id"),
                                                     c["value_type"].alias("value_type")))
    return df.select(
        "id", "name", "description", "asset_id", "external_id", _kv(),
        F.coalesce(cols, F.array().cast("array<struct<name:string,external_id:string,value_type:string>>"))
        .alias("columns"),
        _ts("created_time"), _ts("last_updated_time"), "data_set_id", _audit(run_time))


# --------------------------------------------------------------------- C10
def sequence_rows_with_columns(headers: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the given headers, each carrying its header's columns."""
    ids = F.transform("columns", lambda c: F.struct(c["external_id"].alias("external_id")))  # all that a record needs
    h = headers.select("id", F.col("external_id").alias("seq_external_id"), ids.alias("columns"))
    return rows.join(sized_broadcast(h), "id")


def zip_cells(columns: str = "columns", values: str = "values") -> F.Column:
    """Positional values zipped with column external ids as {key, value}."""
    return F.transform(columns, lambda c, i: F.struct(
        c["external_id"].alias("key"), cell_text(F.get(F.col(values), i)).alias("value")))


def publish_sequence_rows(src, run_time) -> DataFrame:
    df = sequence_rows_with_columns(src.sequence_headers(), src.sequence_rows())
    return df.select("seq_external_id", "row_number", zip_cells().alias("rows"), _audit(run_time))


def publish_sequence_bodies(src, run_time) -> DataFrame:
    """C10 from nested bodies (I2): those of known headers (A11), each record zipped with its body's own columns."""
    known = sized_broadcast(src.sequence_headers().select("id"))
    df = records(src.sequence_body().join(known, "id", "left_semi"))
    return df.select(F.col("external_id").alias("seq_external_id"), "row_number", zip_cells().alias("rows"), _audit(run_time))


# --------------------------------------------------------------------- C11
def publish_ts_headers(src, run_time, since_ms: int | None = None, offset_ms: int = 600000) -> DataFrame:
    df = _maybe_delta(src.ts_headers(), since_ms, offset_ms)
    return df.select(
        "id", "external_id", "name", "description", F.coalesce("is_string", F.lit(False)).alias("is_string"),
        F.coalesce("is_step", F.lit(False)).alias("is_step"), "unit", "asset_id", _longs("security_categories"),
        _ts("created_time"), _ts("last_updated_time"), "data_set_id", _kv(), _audit(run_time))


# --------------------------------------------------------------------- C12
def publishable_series(src, reserved_prefix: str = RESERVED_SERIES_PREFIX, numeric_only: bool = False) -> DataFrame:
    return flt.series_security_filter(src.ts_headers(), reserved_prefix, drop_string_series=numeric_only)


def publish_ts_points(src, run_time, window: tuple[int, int | None] | None = None,
                      reserved_prefix: str = RESERVED_SERIES_PREFIX) -> DataFrame:
    """Points of publishable series in the previous-hour window."""
    window = window or flt.window_previous_hour(run_time)
    heads = publishable_series(src, reserved_prefix).select("id")
    pts = flt.filter_window(src.ts_points(), "timestamp", window)
    df = pts.join(sized_broadcast(heads), "id", "left_semi")
    return df.select("id", "external_id", _ts("timestamp"), "value", "value_string", _audit(run_time))


# --------------------------------------------------------------------- C13
def points_around(points: DataFrame, window: tuple[int, int | None]) -> DataFrame:
    """Per series the last point before the window and, if it is closed, the first after it (the largest value of a millisecond)."""
    t, (lo, hi) = F.col("timestamp"), window

    def one(df, order):
        nearest = df.groupBy("id").agg(F.max(F.struct(order.alias("o"), "value", "external_id", "timestamp")).alias("p"))
        return nearest.select("id", "p.external_id", "p.timestamp", "p.value")

    out = one(points.filter(t < F.lit(lo)), t)
    return out if hi is None else out.unionByName(one(points.filter(t > F.lit(hi)), -t))


def publish_ts_points_hour(src, run_time, window: tuple[int, int | None] | None = None,
                           reserved_prefix: str = RESERVED_SERIES_PREFIX, neighbours: bool = False,
                           fill_empty: bool = False, max_gap_ms: int | None = None) -> DataFrame:
    """Hourly aggregates of numeric publishable series.

    With ``neighbours`` the window is widened to whole hours, and one point outside it on each
    side gives its edge buckets their segments; without, points outside are cut off first.
    ``fill_empty`` adds hours without points in silences of at most ``max_gap_ms``.
    """
    window = window or flt.window_last_days(run_time, 4)
    if neighbours:
        lo, hi = window
        window = lo - lo % HOUR_MS, None if hi is None else hi - hi % HOUR_MS + HOUR_MS - 1
    heads = publishable_series(src, reserved_prefix, numeric_only=True).select("id", "is_step")
    numeric = src.ts_points().filter(F.col("value").isNotNull())
    pts = flt.filter_window(numeric, "timestamp", window)
    if neighbours:
        pts = pts.select("id", "external_id", "timestamp", "value").unionByName(points_around(numeric, window))
    agg = hourly_aggregates(pts.join(sized_broadcast(heads), "id"), fill_empty=fill_empty, max_gap_ms=max_gap_ms)
    if neighbours:
        agg = agg.filter(flt.in_window("hour", window))
    return agg.select(
        "id", "external_id", millis_to_ts("hour").alias("timestamp"), "average", "max", "min", "count",
        "sum", "interpolation", "step_interpolation", "continuous_variance", "discrete_variance",
        "total_variation", _audit(run_time))


# --------------------------------------------------------------------- C14
TEXT_HEADER = "externalId|timestamp|timestamp_datetime|value"
# Fixed value: first instant of the single-series export (2018-11-01T00:00:00Z).
EXPORT_START_MS = 1541030400000


def points_text_lines(src, external_id: str | None, start_ms: int = EXPORT_START_MS) -> DataFrame:
    """``externalId|timestamp|iso|value`` lines of one series
    (all series when ``external_id`` is None). String points print their text."""
    pts = src.ts_points().filter(F.col("timestamp") >= F.lit(start_ms))
    if external_id is not None:
        pts = pts.filter(F.col("external_id") == external_id)
    value = F.coalesce(F.col("value_string"), F.col("value").cast("string"))
    line = F.concat_ws("|", F.coalesce("external_id", F.lit("")), F.col("timestamp").cast("string"),
                       iso_instant("timestamp"), value)
    return pts.select("external_id", "timestamp", line.alias("line"))
