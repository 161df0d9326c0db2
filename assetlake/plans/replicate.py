"""Replicate jobs: source tenant -> target tenant.

Each ``prepare_*`` returns the rows to write to the target in the target's
resource schema (system fields cleared: the target assigns ids and times).
Writing them is an upsert (``assetlake.sinks.upsert``); assets are
synchronised with ``assetlake.sinks.hierarchy_sync``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as K
from ..config import JobConfig
from ..functions.scalars import clamp_value, clean_file_name, ext_id_fallback
from ..operators import filters as flt
from ..operators import remap
from ..operators.hierarchy import hierarchy_diff
from ..operators.joins import sized_broadcast
from ..operators.metrics import Counters, counted
from ..operators.nested import records
from ..operators.rules import clean_file_names, event_rules
from ..sinks.partitioned import latest
from ..sources.files import attach_bodies, binary_bodies, path_key
from ..sources.scan import delta_since, upper_bound

# Delta safety overlaps (ms) of the replicators.
EVENTS_DELTA_OFFSET_MS = 2 * 3600000
FILES_METADATA_DELTA_OFFSET_MS = 60 * 60000


def _null(ddl: str):
    return F.lit(None).cast(ddl)


def _scan(df: DataFrame, run_time, since_ms: int | None, offset_ms: int, mark: Observation | None = None) -> DataFrame:
    """A delta bounded on both sides; ``mark`` observes the latest update time among the rows the job reads."""
    df = upper_bound(df, flt.to_ms(run_time)) if run_time is not None else df
    df = df if since_ms is None else delta_since(df, since_ms, offset_ms)
    return df if mark is None else df.observe(mark, F.max("last_updated_time").alias("mark"))


def _without_ext_id(counters: Counters | None, df: DataFrame) -> DataFrame:
    return counted(counters, df, read=F.lit(1), missing_external_id=F.col("external_id").isNull())


def _links(counters: Counters | None, df: DataFrame, **mapped) -> DataFrame:
    """Counts the links that were mapped, and not: the data set and those given by name."""
    found = {"data_set": F.col("data_set_id").isNotNull()} | mapped
    return counted(counters, df, **{f"{k}_mapped": c for k, c in found.items()}, **{f"{k}_not_mapped": ~F.coalesce(c, F.lit(False)) for k, c in found.items()})


def _map_data_set(df: DataFrame, src, tgt, cfg: JobConfig) -> DataFrame:
    """Data set id through its external id; NULL unless mapping is on and found."""
    if not cfg.flag(K.DATA_SET_MAPPING):
        return df.withColumn("data_set_id", _null("bigint"))
    return remap.remap_scalar(df, "data_set_id", remap.translation(src.data_sets(), tgt.data_sets()))


# ------------------------------------------------------------------ events
def prepare_events(src, tgt, cfg: JobConfig, run_time=None, since_ms: int | None = None,
                   offset_ms: int = EVENTS_DELTA_OFFSET_MS, salts: int = 1, mark: Observation | None = None,
                   counters: Counters | None = None) -> DataFrame:
    """A16-A19, D1, E11, E5, E3, K8-K11, C16. ``salts`` spreads hot asset links
    over several tasks when the asset translation is too large to broadcast."""
    ev = _scan(src.events(), run_time, since_ms, offset_ms, mark)
    ev = flt.data_set_filter(ev, src.data_sets(), cfg.allow_list(K.DATA_SET_EXT_ID))
    ev = _without_ext_id(counters, ev).withColumn("external_id", ext_id_fallback("external_id", "id"))
    if cfg.flag(K.CONTEXTUALIZATION):
        ev = remap.remap_array(ev, "id", "asset_ids", remap.translation(src.assets(), tgt.assets()), salts)
    else:
        ev = ev.withColumn("asset_ids", F.array().cast("array<bigint>"))
    ev = _links(counters, _map_data_set(ev, src, tgt, cfg), assets=F.size("asset_ids") > 0)
    ev = event_rules(ev)
    return ev.select(
        _null("bigint").alias("id"), "external_id", "start_time", "end_time", "description", "type",
        "subtype", "source", "asset_ids", _null("bigint").alias("created_time"),
        _null("bigint").alias("last_updated_time"), "data_set_id", "metadata")


# ------------------------------------------------------------------- files
def prepare_files(src, tgt, cfg: JobConfig, run_time=None, with_content: bool = True,
                  since_ms: int | None = None, offset_ms: int = FILES_METADATA_DELTA_OFFSET_MS,
                  salts: int = 1, newest_only: bool = False, mark: Observation | None = None,
                  counters: Counters | None = None) -> DataFrame:
    """Metadata first, the bodies joined last (``file_bodies``)."""
    f = _scan(src.files().drop("content"), run_time, since_ms, offset_ms, mark)
    f = flt.data_set_filter(f, src.data_sets(), cfg.allow_list(K.DATA_SET_EXT_ID))
    f = _without_ext_id(counters, f).withColumn("external_id", ext_id_fallback("external_id", "id"))
    if cfg.flag(K.CONTEXTUALIZATION):
        f = remap.remap_array(f, "id", "asset_ids", remap.translation(src.assets(), tgt.assets()), salts)
    else:
        f = f.withColumn("asset_ids", F.array().cast("array<bigint>"))
    f = _links(counters, _map_data_set(f, src, tgt, cfg), assets=F.size("asset_ids") > 0)
    if with_content:
        if cfg.flag(K.IGNORE_INVALID_LABELS):
            f = remap.keep_known(f.withColumn("__given", F.size("labels")), "id", "labels", tgt.labels())
            f = counted(counters, f, labels_removed=F.col("__given") - F.size("labels")).drop("__given")
        name = F.coalesce(F.col("name"), F.lit(""))
        f = counted(counters, f, forward_slash=name.contains("/"), back_slash=name.contains("\\"), cleaned=clean_file_name(name) != name)
        f = clean_file_names(f.withColumn("__path", path_key()))  # bodies lie under the name as it was
    cols = [_null("bigint").alias("id"), "external_id", "source_created_time", "source_modified_time",
            "name", "directory", "mime_type", "source", "asset_ids", "security_categories", "labels",
            "uploaded", "uploaded_time", _null("bigint").alias("created_time"),
            _null("bigint").alias("last_updated_time"), "data_set_id", "metadata"]
    if not with_content:
        return f.select(*cols)
    if newest_only:
        f = latest(f, ["external_id"], "last_updated_time")
    key, bodies = file_bodies(src)
    f = f.withColumn("__body", F.col("id") if key is None else F.col(key))
    return attach_bodies(f, bodies, "__body").select(*cols, "content")


def file_bodies(src) -> tuple[str | None, DataFrame]:
    """(metadata column that holds the key or None for the id, bodies as (__body, content)) of a tenant.

    Bodies are a column of the files table, or files of their own below ``src.content_dir``.
    """
    content_dir = getattr(src, "content_dir", None)
    if content_dir:
        return "__path", binary_bodies(src.spark, content_dir).withColumnRenamed("path", "__body")
    return None, src.files().select(F.col("id").alias("__body"), "content").where("content IS NOT NULL AND __body IS NOT NULL")


# ------------------------------------------------------------------ labels
def prepare_labels(src, tgt, cfg: JobConfig, map_data_sets: bool = False, counters: Counters | None = None) -> DataFrame:
    """Created time cleared; data set copied as is unless ``map_data_sets``."""
    lb = src.labels()
    if map_data_sets:
        lb = remap.remap_scalar(lb, "data_set_id", remap.translation(src.data_sets(), tgt.data_sets()))
    return counted(counters, lb, read=F.lit(1), data_set_given=F.col("data_set_id").isNotNull()).select("external_id", "name", "description", "data_set_id",
                     _null("bigint").alias("created_time"))


# --------------------------------------------------------------------- raw
def prepare_raw(src, cfg: JobConfig, counters: Counters | None = None) -> DataFrame:
    """Rows of the raw tables in allowed databases."""
    rows = src.raw_rows()
    allowed = flt.allow_deny_frame(rows, "db_name", cfg.allow_list(K.DB_NAMES), cfg.deny_list(K.DB_NAMES)).select(*rows.columns)
    return counted(counters, allowed, read=F.lit(1))


# ----------------------------------------------------------- relationships
def prepare_relationships(src, tgt, cfg: JobConfig, counters: Counters | None = None) -> DataFrame:
    """D1, E3, C19."""
    r = flt.data_set_filter(src.relationships(), src.data_sets(), cfg.allow_list(K.DATA_SET_EXT_ID))
    r = _links(counters, _map_data_set(counted(counters, r, read=F.lit(1)), src, tgt, cfg))
    return r.withColumn("created_time", _null("bigint")).withColumn("last_updated_time", _null("bigint"))


# --------------------------------------------------------------- sequences
def filtered_sequence_headers(src, cfg: JobConfig) -> DataFrame:
    h = flt.data_set_filter(src.sequence_headers(), src.data_sets(), cfg.allow_list(K.DATA_SET_EXT_ID))
    return flt.allow_deny_frame(h, "external_id", cfg.allow_list(K.SEQUENCE_EXT_ID), cfg.deny_list(K.SEQUENCE_EXT_ID))


def prepare_sequence_headers(src, tgt, cfg: JobConfig, headers: DataFrame | None = None,
                             counters: Counters | None = None) -> DataFrame:
    """D1, D4, E11, E4, E3, C20."""
    h = headers if headers is not None else filtered_sequence_headers(src, cfg)
    h = _without_ext_id(counters, h).withColumn("external_id", ext_id_fallback("external_id", "id"))
    if cfg.flag(K.CONTEXTUALIZATION):
        h = remap.remap_scalar(h, "asset_id", remap.translation(src.assets(), tgt.assets()))
    else:
        h = h.withColumn("asset_id", _null("bigint"))
    h = _links(counters, _map_data_set(h, src, tgt, cfg), asset=F.col("asset_id").isNotNull())
    return h.select(_null("bigint").alias("id"), "external_id", "name", "description", "asset_id",
                    "metadata", "columns", _null("bigint").alias("created_time"),
                    _null("bigint").alias("last_updated_time"), "data_set_id")


def prepare_sequence_rows(src, cfg: JobConfig, headers: DataFrame | None = None, nested: bool = False,
                          counters: Counters | None = None) -> DataFrame:
    """Rows of the replicated headers, keyed by the target external id; ``nested`` reads them from bodies."""
    h = headers if headers is not None else filtered_sequence_headers(src, cfg)
    keys = h.select("id", ext_id_fallback("external_id", "id").alias("seq_external_id"))
    rows = records(src.sequence_body()).select("id", "row_number", "values") if nested else src.sequence_rows()
    return counted(counters, rows.join(sized_broadcast(keys), "id"), rows=F.lit(1)).select("seq_external_id", "row_number", "values")


# ------------------------------------------------------------- time series
def filtered_series(src, cfg: JobConfig, security_filter: bool = False) -> DataFrame:
    """D1, D5 (and the optional security filter, Q9)."""
    h = flt.data_set_filter(src.ts_headers(), src.data_sets(), cfg.allow_list(K.DATA_SET_EXT_ID))
    h = h.filter(flt.regex_allow_deny("external_id", cfg.allow_list(K.TS_EXT_ID), cfg.allow_list(K.TS_EXT_ID_REGEX),
                                      cfg.deny_list(K.TS_EXT_ID), cfg.deny_list(K.TS_EXT_ID_REGEX)))
    if security_filter:
        h = h.filter(F.size("security_categories") == 0)
    return h


def prepare_ts_headers(src, tgt, cfg: JobConfig, headers: DataFrame | None = None,
                       counters: Counters | None = None) -> DataFrame:
    """E11, E4, E3, C21."""
    h = headers if headers is not None else filtered_series(src, cfg)
    h = _without_ext_id(counters, h).withColumn("external_id", ext_id_fallback("external_id", "id"))
    if cfg.flag(K.CONTEXTUALIZATION):
        h = remap.remap_scalar(h, "asset_id", remap.translation(src.assets(), tgt.assets()))
    else:
        h = h.withColumn("asset_id", _null("bigint"))
    h = _links(counters, _map_data_set(h, src, tgt, cfg), asset=F.col("asset_id").isNotNull())
    return h.select(_null("bigint").alias("id"), "external_id", "name", "description", "is_string", "is_step",
                    "unit", "asset_id", F.array().cast("array<bigint>").alias("security_categories"),
                    _null("bigint").alias("created_time"), _null("bigint").alias("last_updated_time"),
                    "data_set_id", "metadata")


def prepare_ts_points(src, cfg: JobConfig, run_time, headers: DataFrame | None = None,
                      counters: Counters | None = None) -> DataFrame:
    """Point posts (external_id, timestamp, value | value_string)."""
    h = headers if headers is not None else filtered_series(src, cfg)
    window = flt.window_config_days(run_time, cfg.integer(K.TS_WINDOW_DAYS, 1))
    pts = flt.filter_window(src.ts_points(), "timestamp", window)
    pts = pts.join(sized_broadcast(h.select("id")), "id", "left_semi")
    pts = counted(counters, pts, points=F.lit(1), string_points=F.col("value_string").isNotNull(),
                  clamped=F.col("value_string").isNull() & (clamp_value("value") != F.col("value")))
    return pts.select(ext_id_fallback("external_id", "id").alias("external_id"), "timestamp",
                      F.when(F.col("value_string").isNull(), clamp_value("value")).alias("value"),
                      "value_string")


# ------------------------------------------------------------------ assets
class MissingKeyError(ValueError):
    pass


def checked_assets(src, cfg: JobConfig) -> DataFrame:
    """The source assets with a ``reason`` why they can't be replicated (NULL: they can)."""
    a = flt.data_set_filter(src.assets(), src.data_sets(), cfg.allow_list(K.DATA_SET_EXT_ID))
    reason = F.concat_ws(", ", F.when(F.col("external_id").isNull(), "no external id"), F.when(F.col("root_id").isNull(), "no root id"))
    return a.withColumn("reason", F.when(reason != "", reason))


def rejected_assets(checked: DataFrame, run_time) -> DataFrame:
    """What is quarantined: the asset's ids and name, the reason, and the run."""
    return checked.where("reason IS NOT NULL").select("id", "external_id", "name", "root_id", "reason", F.lit(flt.to_ms(run_time)).alias("run_time"))


def prepare_assets(src, tgt, cfg: JobConfig, on_invalid: str = "fail", checked: DataFrame | None = None,
                   counters: Counters | None = None) -> DataFrame:
    """Replicated assets with ``root_external_id``.

    D14: an asset without external id or root id fails the job (``on_invalid="fail"``) or is left out
    (``"quarantine"``; ``rejected_assets`` gives those). ``checked`` is a stored ``checked_assets``, so that both
    outputs come from one pass.
    """
    a = checked if checked is not None else checked_assets(src, cfg)
    if on_invalid == "fail" and not a.where("reason IS NOT NULL").isEmpty():
        raise MissingKeyError("source assets must have an external id and a root id")
    a = a.where("reason IS NULL").drop("reason")
    id_map = remap.id_to_ext(src.assets())
    a = remap.parent_and_root_ext(a, id_map)
    a = _links(counters, _map_data_set(a, src, tgt, cfg))
    a = counted(counters, a, read=F.lit(1), root=F.col("parent_external_id").isNull())
    a = flt.allow_deny_frame(a, "root_external_id", cfg.allow_list(K.ROOT_ASSET_EXT_ID), cfg.deny_list(K.ROOT_ASSET_EXT_ID))
    return a.select("external_id", "name", "parent_external_id", "description", "source", "data_set_id",
                    "labels", "metadata", "root_external_id")


def target_assets_with_root(tgt) -> DataFrame:
    """Target assets with their root's external id (E7 on the target side)."""
    t = tgt.assets()
    return remap.parent_and_root_ext(t.drop("parent_external_id"), remap.id_to_ext(t))


def plan_hierarchy_sync(src, tgt, cfg: JobConfig, on_invalid: str = "fail") -> DataFrame:
    """Create / update / delete / unchanged per asset."""
    return hierarchy_diff(prepare_assets(src, tgt, cfg, on_invalid), target_assets_with_root(tgt))
