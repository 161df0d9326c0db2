"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written against the driver views with the derived tables of
``oracle_fixtures.py``; the lookups follow the reference semantics literally
(per-row two-hop map lookups with the id-as-text fallback), not the
pre-joined translation used on the Spark side.
"""

from __future__ import annotations

from ..operators import filters as flt
from ..operators.rules import (DESCRIPTION_KEY, DESCRIPTION_NOTE, END_KEY, END_NEGATIVE_NOTE, ORIGINAL_FILE_NAME_KEY,
                               START_AFTER_END_NOTE, START_KEY, START_NEGATIVE_NOTE)
from .oracle_fixtures import with_ctes
from .params import DELTA_MARK_MS, DELTA_OFFSET_MS, EXPORT_SERIES, FILL_GAP_MS, RUN_MS, RUN_TIME, RUN_TS_TEXT

CAP = 253402300799990


def TS(e: str) -> str:
    return f"strftime(epoch_ms({e}), '%Y-%m-%d %H:%M:%S.%g')"


def KV(e: str) -> str:
    return (f"array_to_string(list_transform(list_sort(map_entries({e})), "
            f"lambda x: x.key || '=' || coalesce(x.value, '')), ';')")


def ARR(e: str) -> str:
    return f"array_to_string({e}, ',')"


def R6(e: str) -> str:
    return f"round({e}, 6)"


RUT = f"'{RUN_TS_TEXT}' AS row_updated_time"

# lookup maps (E1/E2): blank external ids dropped, max per key
MAPS = {
    "sam": "SELECT id, max(external_id) AS ext FROM src_assets WHERE id IS NOT NULL AND external_id <> '' GROUP BY id",
    "tam": "SELECT external_id AS ext, max(id) AS tid FROM tgt_assets WHERE id IS NOT NULL AND external_id <> '' "
           "GROUP BY external_id",
    "sdm": "SELECT id, max(external_id) AS ext FROM src_data_sets WHERE id IS NOT NULL AND external_id <> '' "
           "GROUP BY id",
    "tdm": "SELECT external_id AS ext, max(id) AS tid FROM tgt_data_sets WHERE id IS NOT NULL AND external_id <> '' "
           "GROUP BY external_id",
}
MAP_DEPS = {"sam": "src_assets", "tam": "tgt_assets", "sdm": "src_data_sets", "tdm": "tgt_data_sets"}


def q(body: str, *fixtures: str, maps: tuple[str, ...] = (), extra: str = "", recursive: bool = False) -> str:
    names = list(fixtures) + [MAP_DEPS[m] for m in maps]
    sql = with_ctes("SELECT 1", *names)
    ctes = sql[len("WITH "):-len("\nSELECT 1")] if sql.startswith("WITH ") else ""
    parts = [p for p in [ctes] + [f"{m} AS ({MAPS[m]})" for m in maps] + ([extra] if extra else []) if p]
    head = ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" if parts else ""
    return head + body


def ds_remap(alias: str, col: str = "data_set_id") -> str:
    """Two left joins: source id -> ext (fallback id text) -> target id."""
    return (f"LEFT JOIN sdm ON sdm.id = {alias}.{col} "
            f"LEFT JOIN tdm ON tdm.ext = coalesce(sdm.ext, CAST({alias}.{col} AS VARCHAR))")


def asset_array_remap(table: str, arr: str = "asset_ids") -> str:
    """CTE ``amap(id, mapped)``: element-wise two-hop lookup, order and duplicates kept."""
    return f"""
aelem AS (SELECT id, unnest({arr}) AS aid, generate_subscripts({arr}, 1) AS pos FROM {table}),
amap AS (SELECT aelem.id, list(tam.tid ORDER BY aelem.pos) AS mapped FROM aelem
         LEFT JOIN sam ON sam.id = aelem.aid
         JOIN tam ON tam.ext = coalesce(sam.ext, CAST(aelem.aid AS VARCHAR)) GROUP BY aelem.id)"""


def hourly(points_select: str, hours_where: str = "true") -> str:
    """CTE ``hourly`` over ``points_select(id, external_id, timestamp, value, is_step)``, straight from the definition.

    The points of a series, one a millisecond, are joined by segments (constant in step series). Every segment is
    clipped to every hour that holds a point; the continuous aggregates are integrals over the clipped pieces, the
    variance taken around the hour's own mean.
    """
    at = lambda x: f"CASE WHEN is_step THEN v ELSE v + (nv - v) * CAST({x} - t AS DOUBLE) / CAST(nt - t AS DOUBLE) END"
    return f"""
hp AS ({points_select}),
hp1 AS (SELECT id, timestamp AS t, max(value) AS v, max(external_id) AS external_id, bool_or(coalesce(is_step, false)) AS is_step
        FROM hp GROUP BY id, timestamp),
hp2 AS (SELECT *, t - (t % 3600000) AS hour, lead(t) OVER w AS nt, lead(v) OVER w AS nv, lag(v) OVER w AS pv FROM hp1
        WINDOW w AS (PARTITION BY id ORDER BY t)),
hb AS (SELECT id, hour, max(external_id) AS external_id, avg(v) AS average, max(v) AS max, min(v) AS min, count(v) AS count, sum(v) AS sum,
              var_pop(v) AS discrete_variance, max(v) FILTER (WHERE t = hour) AS at_hour,
              sum(abs(v - pv)) FILTER (WHERE is_step) AS jumps
       FROM hp2 WHERE {hours_where} GROUP BY id, hour),
hc AS (SELECT hb.id, hb.hour, p.t, p.v, p.nt, p.nv, p.is_step, greatest(p.t, hb.hour) AS a, least(p.nt, hb.hour + 3600000) AS b
       FROM hb JOIN hp2 p ON p.id = hb.id AND p.t < hb.hour + 3600000 AND p.nt > hb.hour),
hd AS (SELECT id, hour, is_step, v, a = hour AS opens, CAST(b - a AS DOUBLE) AS dt, {at('a')} AS va, {at('b')} AS vb FROM hc),
hm AS (SELECT id, hour, sum(dt) AS total, sum((va + vb) / 2 * dt) / sum(dt) AS mean FROM hd GROUP BY id, hour),
hv AS (SELECT hd.id, hd.hour, max(total) AS total,
              sum(((va - mean) * (va - mean) + (va - mean) * (vb - mean) + (vb - mean) * (vb - mean)) / 3 * dt) / max(total) AS continuous_variance,
              sum(abs(vb - va)) FILTER (WHERE NOT is_step) AS slopes, max(va) FILTER (WHERE opens) AS open_value, max(v) FILTER (WHERE opens) AS open_step
       FROM hd JOIN hm ON hm.id = hd.id AND hm.hour = hd.hour GROUP BY hd.id, hd.hour),
hourly AS (SELECT hb.id, hb.external_id, hb.hour, average, max, min, count, sum, coalesce(open_value, at_hour) AS interpolation,
                  coalesce(open_step, at_hour) AS step_interpolation, continuous_variance, discrete_variance,
                  coalesce(slopes, jumps, 0.0) AS total_variation
           FROM hb LEFT JOIN hv ON hv.id = hb.id AND hv.hour = hb.hour)"""


HIER = """
h(id, depth, path) AS (
  SELECT id, CAST(0 AS BIGINT), [id] FROM src_assets WHERE parent_id IS NULL
  UNION ALL
  SELECT a.id, h.depth + 1, list_append(h.path, a.id) FROM src_assets a JOIN h ON a.parent_id = h.id
  WHERE NOT list_contains(h.path, a.id)),
cc AS (SELECT parent_id AS id, count(*) AS child_count FROM src_assets WHERE parent_id IS NOT NULL GROUP BY parent_id)"""

PUBLISHABLE = "len(h.security_categories) = 0 AND NOT starts_with(coalesce(h.name, ''), 'SYS-')"


def _win(lo_hi) -> str:
    lo, hi = lo_hi
    return f"timestamp >= {lo}" + (f" AND timestamp <= {hi}" if hi is not None else "")


def events_publish(where: str) -> str:
    return q(f"""
SELECT id, external_id, {TS('start_time')} AS start_time,
       {TS(f'CASE WHEN end_time > {CAP} THEN {CAP} ELSE end_time END')} AS end_time,
       description, type, subtype, source, {ARR('asset_ids')} AS asset_ids, {TS('created_time')} AS created_time,
       {TS('last_updated_time')} AS last_updated_time, data_set_id, {KV('metadata')} AS metadata, {RUT}
FROM src_events {where}""", "src_events")


def event_rules_cte(table: str) -> str:
    """CTE ``ruled``: K8-K11 applied in order to ``table``."""
    return f"""
r1 AS (SELECT *, coalesce(start_time < 0, false) AS k8,
              CASE WHEN start_time < 0 THEN CAST(0 AS BIGINT) ELSE start_time END AS s1 FROM {table}),
r2 AS (SELECT *, coalesce(end_time < 0, false) AS k9,
              CASE WHEN end_time < 0 THEN coalesce(s1, CAST(0 AS BIGINT)) ELSE end_time END AS e1 FROM r1),
r3 AS (SELECT *, (s1 IS NOT NULL AND e1 IS NOT NULL AND s1 > e1) AS k10 FROM r2),
r4 AS (SELECT *, CASE WHEN k10 THEN e1 ELSE s1 END AS s2, coalesce(length(description) > 500, false) AS k11 FROM r3),
ruled AS (SELECT * REPLACE (s2 AS start_time, e1 AS end_time,
                 CASE WHEN k11 THEN substr(description, 1, 500) ELSE description END AS description,
                 CASE WHEN k11 THEN map_concat(m3, MAP {{'{DESCRIPTION_KEY}': '{DESCRIPTION_NOTE}'}}) ELSE m3 END AS metadata)
          FROM (SELECT *,
                  CASE WHEN k10 THEN map_concat(m2, MAP {{'{START_KEY}': '{START_AFTER_END_NOTE}'}}) ELSE m2 END AS m3
                FROM (SELECT *,
                        CASE WHEN k9 THEN map_concat(m1, MAP {{'{END_KEY}': '{END_NEGATIVE_NOTE}'}}) ELSE m1 END AS m2
                      FROM (SELECT *,
                              CASE WHEN k8 THEN map_concat(coalesce(metadata, MAP {{}}), MAP {{'{START_KEY}': '{START_NEGATIVE_NOTE}'}})
                                   ELSE metadata END AS m1 FROM r4))))"""


def replicate_events_sql(where: str, final: str) -> str:
    """``final`` runs over CTE ``rep``: the replicate-events transform of ``src_events WHERE ...``."""
    extra = (f"ev0 AS (SELECT * FROM src_events {where}),"
             + asset_array_remap("ev0") + f""",
ev1 AS (SELECT e.id, coalesce(e.external_id, CAST(e.id AS VARCHAR)) AS external_id, e.start_time, e.end_time,
               e.description, e.type, e.subtype, e.source,
               coalesce(amap.mapped, CAST([] AS BIGINT[])) AS asset_ids, tdm.tid AS data_set_id, e.metadata
        FROM ev0 e LEFT JOIN amap ON amap.id = e.id {ds_remap('e')}),""" + event_rules_cte("ev1") + """,
rep AS (SELECT CAST(NULL AS BIGINT) AS id, external_id, start_time, end_time, description, type, subtype, source,
               asset_ids, CAST(NULL AS BIGINT) AS created_time, CAST(NULL AS BIGINT) AS last_updated_time,
               data_set_id, metadata FROM ruled)""")
    return q(final, "src_events", "tgt_events", "src_assets", "tgt_assets", "src_data_sets", "tgt_data_sets",
             maps=("sam", "tam", "sdm", "tdm"), extra=extra)


EVENT_OUT = f"""id, external_id, start_time, end_time, description, type, subtype, source,
{ARR('asset_ids')} AS asset_ids, created_time, last_updated_time, data_set_id, {KV('metadata')} AS metadata"""


def files_sql(content: bool, where: str) -> str:
    labels = ("coalesce(lk.kept, CAST([] AS VARCHAR[]))" if content else "f.labels")
    name = "translate(f.name, '/\\', '--')" if content else "f.name"
    meta = (f"CASE WHEN translate(f.name, '/\\', '--') <> f.name THEN map_concat(f.metadata, "
            f"MAP {{'{ORIGINAL_FILE_NAME_KEY}': f.name}}) ELSE f.metadata END" if content else "f.metadata")
    extra = f"""f0 AS (SELECT * FROM src_files {where}),""" + asset_array_remap("f0") + """,
lel AS (SELECT id, unnest(labels) AS l, generate_subscripts(labels, 1) AS pos FROM f0),
lk AS (SELECT id, list(l ORDER BY pos) AS kept FROM lel WHERE l IN (SELECT external_id FROM tgt_labels) GROUP BY id)"""
    cols = f"""CAST(NULL AS BIGINT) AS id, coalesce(f.external_id, CAST(f.id AS VARCHAR)) AS external_id,
       f.source_created_time, f.source_modified_time, {name} AS name, f.directory, f.mime_type, f.source,
       {ARR('coalesce(amap.mapped, CAST([] AS BIGINT[]))')} AS asset_ids, {ARR('f.security_categories')} AS security_categories,
       {ARR(labels)} AS labels, f.uploaded, f.uploaded_time, CAST(NULL AS BIGINT) AS created_time,
       CAST(NULL AS BIGINT) AS last_updated_time, tdm.tid AS data_set_id, {KV(meta)} AS metadata"""
    if content:
        cols += ", md5(f.content) AS content"
    return q(f"""SELECT {cols}
FROM f0 f LEFT JOIN amap ON amap.id = f.id LEFT JOIN lk ON lk.id = f.id {ds_remap('f')}""",
             "src_files", "tgt_labels", maps=("sam", "tam", "sdm", "tdm"), extra=extra)


PREPARED_ASSETS = f"""
pa AS (SELECT a.external_id, a.name, pm.ext AS parent_external_id, a.description, a.source, tdm.tid AS data_set_id,
              a.labels, a.metadata, coalesce(rm.ext, '') AS root_external_id
       FROM src_assets a LEFT JOIN sam pm ON pm.id = a.parent_id LEFT JOIN sam rm ON rm.id = a.root_id
       {ds_remap('a')}
       WHERE a.external_id IS NOT NULL AND a.root_id IS NOT NULL
         AND NOT coalesce(coalesce(rm.ext, '') IN ('R:1'), false)
         AND coalesce(coalesce(rm.ext, '') IN ('R:0', 'R:1', 'R:2', 'R:4'), false)),
ttm AS (SELECT id, max(external_id) AS ext FROM tgt_assets WHERE id IS NOT NULL AND external_id <> '' GROUP BY id),
ta AS (SELECT t.id, t.external_id, t.name, pm.ext AS parent_external_id, t.description, t.source, t.data_set_id,
              t.labels, t.metadata, coalesce(rm.ext, '') AS root_external_id, t.created_time, t.last_updated_time
       FROM tgt_assets t LEFT JOIN ttm pm ON pm.id = t.parent_id LEFT JOIN ttm rm ON rm.id = t.root_id),
scope AS (SELECT DISTINCT root_external_id FROM pa),
tin AS (SELECT * FROM ta WHERE root_external_id IN (SELECT root_external_id FROM scope)
             OR external_id IN (SELECT external_id FROM pa)),
diff AS (SELECT coalesce(pa.external_id, tin.external_id) AS external_id,
                coalesce(pa.root_external_id, tin.root_external_id) AS root_external_id,
                CASE WHEN tin.external_id IS NULL THEN 'create' WHEN pa.external_id IS NULL THEN 'delete'
                     WHEN pa.name IS NOT DISTINCT FROM tin.name
                      AND pa.parent_external_id IS NOT DISTINCT FROM tin.parent_external_id
                      AND pa.description IS NOT DISTINCT FROM tin.description
                      AND pa.source IS NOT DISTINCT FROM tin.source
                      AND pa.data_set_id IS NOT DISTINCT FROM tin.data_set_id
                      AND pa.labels IS NOT DISTINCT FROM tin.labels
                      AND {KV('pa.metadata')} IS NOT DISTINCT FROM {KV('tin.metadata')}
                      AND pa.root_external_id IS NOT DISTINCT FROM tin.root_external_id THEN 'unchanged'
                     ELSE 'update' END AS op
         FROM pa FULL OUTER JOIN tin ON pa.external_id = tin.external_id)"""


def build() -> dict[str, str]:
    S: dict[str, str] = {}
    A = ("src_assets", "tgt_assets", "src_data_sets", "tgt_data_sets")
    # ------------------------------------------------------------ publish
    S["q_publish_assets"] = q(f"""
SELECT a.id, a.external_id, a.name, a.parent_id, a.parent_external_id, a.description, a.root_id, a.source,
       {TS('a.created_time')} AS created_time, {TS('a.last_updated_time')} AS last_updated_time, a.data_set_id,
       {ARR('a.labels')} AS labels, {KV('a.metadata')} AS metadata,
       CAST(coalesce(cc.child_count, 0) AS BIGINT) AS child_count, h.depth,
       {ARR('coalesce(h.path, CAST([] AS BIGINT[]))')} AS path, {RUT}
FROM src_assets a LEFT JOIN h ON a.id = h.id LEFT JOIN cc ON a.id = cc.id""", "src_assets", extra=HIER, recursive=True)
    S["q_publish_data_sets"] = q(f"""
SELECT id, external_id, name, description, {KV('metadata')} AS metadata, write_protected,
       {TS('created_time')} AS created_time, {TS('last_updated_time')} AS last_updated_time, {RUT}
FROM src_data_sets""", "src_data_sets")
    S["q_publish_events"] = events_publish("")
    S["q_publish_files"] = q(f"""
SELECT id, external_id, {TS('source_created_time')} AS source_created_time,
       {TS('source_modified_time')} AS source_modified_time, name, directory, mime_type, source,
       {ARR('asset_ids')} AS asset_ids, {ARR('security_categories')} AS security_categories, {ARR('labels')} AS labels,
       uploaded, {TS('uploaded_time')} AS uploaded_time, {TS('created_time')} AS created_time,
       {TS('last_updated_time')} AS last_updated_time, data_set_id, {KV('metadata')} AS metadata, {RUT}
FROM src_files""", "src_files")
    S["q_publish_labels"] = q(f"""
SELECT external_id, name, description, data_set_id, {TS('created_time')} AS created_time, {RUT}
FROM src_labels""", "src_labels")
    S["q_publish_raw"] = q(f"""
SELECT db_name, table_name, key AS row_key, {TS('last_updated_time')} AS last_updated_time,
       columns_text AS columns, {RUT}
FROM src_raw WHERE last_updated_time <= {RUN_MS}""", "src_raw")
    S["q_publish_relationships"] = q(f"""
SELECT external_id, source_external_id, source_type, target_external_id, target_type,
       {TS('start_time')} AS start_time, {TS('end_time')} AS end_time, {R6('confidence')} AS confidence,
       data_set_id, {ARR('labels')} AS labels, {TS('created_time')} AS created_time,
       {TS('last_updated_time')} AS last_updated_time, {RUT}
FROM src_relationships""", "src_relationships")
    S["q_publish_sequence_columns"] = q(f"""
SELECT struct_extract(c, 'name') AS name, struct_extract(c, 'external_id') AS external_id, seq_external_id,
       struct_extract(c, 'description') AS description, struct_extract(c, 'value_type') AS value_type,
       {KV("struct_extract(c, 'metadata')")} AS metadata, {TS("struct_extract(c, 'created_time')")} AS created_time,
       {TS("struct_extract(c, 'last_updated_time')")} AS last_updated_time, {RUT}
FROM (SELECT external_id AS seq_external_id, unnest(columns) AS c FROM seq_headers)""", "seq_headers")
    cols_txt = ("array_to_string(list_transform(columns, lambda c: c.name || ':' || c.external_id || ':' || "
                "c.value_type), ';')")
    S["q_publish_sequence_headers"] = q(f"""
SELECT id, name, description, asset_id, external_id, {KV('metadata')} AS metadata, {cols_txt} AS columns,
       {TS('created_time')} AS created_time, {TS('last_updated_time')} AS last_updated_time, data_set_id, {RUT}
FROM seq_headers""", "seq_headers")
    S["q_publish_sequence_rows"] = q(f"""
SELECT h.external_id AS seq_external_id, r.row_number,
       'flag=' || r.c_flag || ';late=' || r.c_late || ';price=' || r.c_price || ';qty=' || r.c_qty AS rows, {RUT}
FROM seq_rows r JOIN seq_headers h ON r.id = h.id""", "seq_rows", "seq_headers")
    body = "seq_rows r JOIN seq_headers h ON r.id = h.id WHERE (r.id - 8000000) % 13 <> 0 AND (r.id - 8000000) % 17 <> 0"
    S["q_publish_sequence_bodies"] = q(f"""
SELECT h.external_id AS seq_external_id, r.row_number,
       'flag=' || CASE WHEN (r.id - 8000000) % 7 = 0 THEN '' ELSE r.c_flag END
       || CASE WHEN (r.id - 8000000) % 11 = 0 THEN '' WHEN (r.id - 8000000) % 7 = 0 THEN ';late=' ELSE ';late=' || r.c_late END
       || ';price=' || r.c_price || ';qty=' || r.c_qty AS rows, {RUT}
FROM {body}""", "seq_rows", "seq_headers")
    S["q_sequence_last_record"] = q(f"""
SELECT s.id, s.external_id, count(b.row_number) AS n_records, max(b.row_number) AS last_row_number
FROM seq_headers s LEFT JOIN (SELECT r.id, r.row_number FROM {body}) b ON b.id = s.id GROUP BY s.id, s.external_id""",
                                    "seq_rows", "seq_headers")
    S["q_publish_ts_headers"] = q(f"""
SELECT id, external_id, name, description, is_string, is_step, unit, asset_id,
       {ARR('security_categories')} AS security_categories, {TS('created_time')} AS created_time,
       {TS('last_updated_time')} AS last_updated_time, data_set_id, {KV('metadata')} AS metadata, {RUT}
FROM ts_headers""", "ts_headers")
    S["q_publish_ts_points"] = q(f"""
SELECT p.id, p.external_id, {TS('p.timestamp')} AS timestamp, {R6('p.value')} AS value, p.value_string, {RUT}
FROM ts_points p JOIN ts_headers h ON p.id = h.id
WHERE {PUBLISHABLE} AND {_win(flt.window_previous_hour(RUN_TIME)).replace('timestamp', 'p.timestamp')}""",
                                   "ts_points", "ts_headers")
    lo4 = flt.window_last_days(RUN_TIME, 4)[0]
    S["q_publish_ts_points_hour"] = q(f"""
SELECT id, external_id, {TS('hour')} AS timestamp, {R6('average')} AS average, {R6('max')} AS max, {R6('min')} AS min,
       count, {R6('sum')} AS sum, {R6('interpolation')} AS interpolation,
       {R6('step_interpolation')} AS step_interpolation, {R6('continuous_variance')} AS continuous_variance,
       {R6('discrete_variance')} AS discrete_variance, {R6('total_variation')} AS total_variation, {RUT}
FROM hourly""", "ts_points", "ts_headers", extra=hourly(f"""
SELECT p.id, p.external_id, p.timestamp, p.value, h.is_step FROM ts_points p JOIN ts_headers h ON p.id = h.id
WHERE {PUBLISHABLE} AND NOT coalesce(h.is_string, false) AND p.value IS NOT NULL""", f"hour >= {lo4 - lo4 % 3600000}"))
    # ------------------------------------------------------------- scans
    S["q_asset_path_depth_children"] = q(f"""
SELECT a.id, h.depth, {ARR('h.path')} AS path, CAST(coalesce(cc.child_count, 0) AS BIGINT) AS child_count
FROM (SELECT DISTINCT id FROM src_assets WHERE id IS NOT NULL) a LEFT JOIN h ON a.id = h.id
LEFT JOIN cc ON a.id = cc.id""", "src_assets", extra=HIER, recursive=True)
    S["q_raw_catalog"] = q("SELECT DISTINCT db_name, table_name FROM src_raw_cells", "src_raw_cells")
    S["q_delta_events"] = events_publish(f"WHERE last_updated_time > {DELTA_MARK_MS - DELTA_OFFSET_MS}")
    S["q_full_read_events"] = events_publish(f"WHERE last_updated_time <= {RUN_MS}")
    # ----------------------------------------------------------- filters
    S["q_filter_root_allow_deny"] = q(f"""
SELECT external_id, name, parent_external_id, description, source, data_set_id, {ARR('labels')} AS labels,
       {KV('metadata')} AS metadata, root_external_id FROM pa""", *A, maps=("sam", "sdm", "tdm"),
                                      extra=PREPARED_ASSETS.split(",\nttm AS")[0])
    denied = "coalesce(external_id IN (SELECT 'ev:' || k FROM range(0, 20000, 10) r(k)), false)"
    S["q_filter_long_lists"] = q(f"""
SELECT 'listed' AS rule, id FROM src_events WHERE external_id IN (SELECT 'ev:' || k FROM range(0, 6000, 2) r(k)) AND NOT {denied}
UNION ALL SELECT 'every', id FROM src_events WHERE NOT {denied}""", "src_events")
    S["q_asset_quarantine"] = q("""
SELECT id, CASE WHEN external_id IS NULL OR root_id IS NULL THEN 'rejected' ELSE 'accepted' END AS state,
       CASE WHEN external_id IS NULL AND root_id IS NULL THEN 'no external id, no root id' WHEN external_id IS NULL THEN 'no external id'
            WHEN root_id IS NULL THEN 'no root id' END AS reason
FROM src_assets""", "src_assets")
    S["q_filter_raw_db"] = q("""
SELECT db_name, table_name, key, last_updated_time, columns_text AS columns FROM src_raw WHERE db_name = 'geo'""",
                             "src_raw")
    S["q_filter_sequences"] = q("""
SELECT id, external_id FROM seq_headers
WHERE NOT coalesce(external_id IN ('seq:1', 'seq:2', 'seq:3', 'seq:100'), false)""", "seq_headers")
    S["q_filter_ts_regex"] = q("""
SELECT id, external_id FROM ts_headers
WHERE NOT (coalesce(external_id IN ('ts:25'), false) OR coalesce(regexp_full_match(external_id, 'ts:.*7'), false))
  AND (coalesce(external_id IN ('ts:1', 'ts:3'), false) OR coalesce(regexp_full_match(external_id, 'ts:2.*'), false)
       OR coalesce(regexp_full_match(external_id, 'ts:1[0-9]'), false))""", "ts_headers")
    S["q_filter_data_set"] = q("""
SELECT id, data_set_id FROM src_events
WHERE data_set_id IN (SELECT id FROM src_data_sets WHERE external_id IN ('ds:ASIA', 'ds:EUROPE'))""",
                               "src_events", "src_data_sets")
    S["q_filter_ts_security"] = q(f"""
SELECT id, name, is_string FROM ts_headers h WHERE {PUBLISHABLE} AND NOT coalesce(is_string, false)""",
                                  "ts_headers")
    S["q_window_hour"] = q(f"SELECT id, timestamp FROM ts_points WHERE {_win(flt.window_previous_hour(RUN_TIME))}",
                           "ts_points")
    S["q_window_days"] = q(f"SELECT id, timestamp FROM ts_points WHERE {_win(flt.window_last_days(RUN_TIME, 4))}",
                           "ts_points")
    S["q_window_config_full"] = q(
        f"SELECT id, timestamp FROM ts_points WHERE {_win(flt.window_config_days(RUN_TIME, -1))}", "ts_points")
    # ------------------------------------------------------------- joins
    S["q_id_maps"] = q("""
SELECT sam.id AS src_id, tam.tid AS tgt_id FROM sam JOIN tam ON sam.ext = tam.ext
UNION ALL
SELECT TRY_CAST(ext AS BIGINT) AS src_id, tid AS tgt_id FROM tam
WHERE TRY_CAST(ext AS BIGINT) IS NOT NULL AND CAST(TRY_CAST(ext AS BIGINT) AS VARCHAR) = ext
  AND TRY_CAST(ext AS BIGINT) NOT IN (SELECT id FROM sam)""", maps=("sam", "tam"))
    S["q_remap_data_set"] = q(f"""
SELECT e.id, tdm.tid AS data_set_id FROM src_events e {ds_remap('e')}""", "src_events", maps=("sdm", "tdm"))
    S["q_remap_scalar_asset"] = q("""
SELECT h.id, tam.tid AS asset_id FROM ts_headers h LEFT JOIN sam ON sam.id = h.asset_id
LEFT JOIN tam ON tam.ext = coalesce(sam.ext, CAST(h.asset_id AS VARCHAR))""", "ts_headers", maps=("sam", "tam"))
    S["q_remap_array_asset"] = q(f"""
SELECT e.id, {ARR('coalesce(amap.mapped, CAST([] AS BIGINT[]))')} AS asset_ids
FROM src_events e LEFT JOIN amap ON amap.id = e.id""", "src_events", maps=("sam", "tam"),
                                 extra=asset_array_remap("src_events").strip())
    S["q_parent_root_external"] = q("""
SELECT a.id, a.parent_id, a.root_id, pm.ext AS parent_external_id, coalesce(rm.ext, '') AS root_external_id
FROM src_assets a LEFT JOIN sam pm ON pm.id = a.parent_id LEFT JOIN sam rm ON rm.id = a.root_id""",
                                    "src_assets", maps=("sam",))
    S["q_valid_labels"] = q(f"""
SELECT f.id, {ARR('coalesce(lk.kept, CAST([] AS VARCHAR[]))')} AS labels FROM src_files f LEFT JOIN lk ON lk.id = f.id""",
                            "src_files", "tgt_labels", extra="""
lel AS (SELECT id, unnest(labels) AS l, generate_subscripts(labels, 1) AS pos FROM src_files),
lk AS (SELECT id, list(l ORDER BY pos) AS kept FROM lel WHERE l IN (SELECT external_id FROM tgt_labels) GROUP BY id)""")
    S["q_ext_id_fallback"] = q("""
SELECT 'event' AS kind, id, coalesce(external_id, CAST(id AS VARCHAR)) AS external_id FROM src_events
UNION ALL SELECT 'series', id, coalesce(external_id, CAST(id AS VARCHAR)) FROM ts_headers
UNION ALL SELECT 'sequence', id, coalesce(external_id, CAST(id AS VARCHAR)) FROM seq_headers
UNION ALL SELECT 'file', id, coalesce(external_id, CAST(id AS VARCHAR)) FROM src_files""",
                               "src_events", "ts_headers", "seq_headers", "src_files")
    # ------------------------------------------------------ aggregations
    all_pts = """
SELECT p.id, p.external_id, p.timestamp, p.value, h.is_step FROM ts_points p JOIN ts_headers h ON p.id = h.id
WHERE p.value IS NOT NULL AND NOT h.is_string"""
    S["q_hour_basic"] = q(f"""
SELECT id, hour, {R6('average')} AS average, {R6('max')} AS max, {R6('min')} AS min, count, {R6('sum')} AS sum,
       {R6('discrete_variance')} AS discrete_variance FROM hourly""", "ts_points", "ts_headers", extra=hourly(all_pts))
    S["q_hour_continuous"] = q(f"""
SELECT id, hour, {R6('interpolation')} AS interpolation, {R6('step_interpolation')} AS step_interpolation,
       {R6('continuous_variance')} AS continuous_variance, {R6('total_variation')} AS total_variation FROM hourly""",
                               "ts_points", "ts_headers", extra=hourly(all_pts))
    at = lambda x: f"CASE WHEN is_step THEN v ELSE v + (nv - v) * CAST({x} - t AS DOUBLE) / CAST(nt - t AS DOUBLE) END"
    S["q_hour_filled"] = q(f"""
SELECT id, external_id, hour, {R6('average')} AS average, count, {R6('interpolation')} AS interpolation,
       {R6('step_interpolation')} AS step_interpolation, {R6('continuous_variance')} AS continuous_variance,
       {R6('total_variation')} AS total_variation
FROM (SELECT id, external_id, hour, average, count, interpolation, step_interpolation, continuous_variance, total_variation FROM hourly
      UNION ALL
      SELECT id, external_id, h, NULL, 0, va, v, (vb - va) * (vb - va) / 12, abs(vb - va)
      FROM (SELECT *, {at('h')} AS va, {at('h + 3600000')} AS vb
            FROM (SELECT *, unnest(range(hour + 3600000, nt - nt % 3600000, 3600000)) AS h FROM hp2 WHERE nt - t <= {FILL_GAP_MS})))""",
                           "ts_points", "ts_headers", extra=hourly(all_pts))
    S["q_batches"] = q("""
SELECT bucket, batch, count(*) AS n_items, min(id) AS first_id, max(id) AS last_id
FROM (SELECT id, id % 20 AS bucket,
             CAST(floor((row_number() OVER (PARTITION BY id % 20 ORDER BY id) - 1) / 20) AS BIGINT) AS batch
      FROM ts_headers) GROUP BY bucket, batch""", "ts_headers")
    # ------------------------------------------------------------- rules
    S["q_event_rules"] = q(f"""
SELECT id, start_time, end_time, description, {KV('metadata')} AS metadata FROM ruled""", "src_events",
                           extra=event_rules_cte("src_events").strip())
    S["q_event_end_cap"] = q(f"""
SELECT id, CASE WHEN end_time > {CAP} THEN {CAP} ELSE end_time END AS end_time FROM src_events""", "src_events")
    S["q_clamp_points"] = """
SELECT id, CASE WHEN isnan(v) THEN v WHEN v > 1e100 THEN 1e100 WHEN v < -1e100 THEN -1e100 ELSE v END AS value
FROM (SELECT event_id AS id,
             CASE WHEN event_id % 101 = 0 THEN CAST('nan' AS DOUBLE) WHEN event_id % 103 = 0 THEN CAST('inf' AS DOUBLE)
                  WHEN event_id % 107 = 0 THEN CAST('-inf' AS DOUBLE)
                  ELSE value * 1e99 * CASE WHEN event_id % 2 = 1 THEN -1.0 ELSE 1.0 END END AS v FROM events)"""
    S["q_clean_file_names"] = q(f"""
SELECT id, translate(name, '/\\', '--') AS name,
       {KV(f"CASE WHEN translate(name, '/\\', '--') <> name THEN map_concat(metadata, MAP {{'{ORIGINAL_FILE_NAME_KEY}': name}}) ELSE metadata END")} AS metadata
FROM src_files""", "src_files")
    S["q_metadata_put"] = q(f"""
SELECT id, {KV("map_concat(metadata, MAP {'type': coalesce(type, '')})")} AS metadata FROM src_events""",
                            "src_events")
    iso = ("CASE WHEN timestamp % 1000 = 0 THEN strftime(epoch_ms(timestamp), '%Y-%m-%dT%H:%M:%SZ') "
           "ELSE strftime(epoch_ms(timestamp), '%Y-%m-%dT%H:%M:%S.%gZ') END")
    S["q_text_lines"] = q(f"""
SELECT external_id, timestamp,
       concat_ws('|', coalesce(external_id, ''), CAST(timestamp AS VARCHAR), {iso},
                 coalesce(value_string, CAST(value AS VARCHAR))) AS line
FROM ts_points WHERE timestamp >= 1541030400000""", "ts_points")
    # --------------------------------------------------------- replicate
    S["q_replicate_events"] = replicate_events_sql(f"WHERE last_updated_time <= {RUN_MS}",
                                                   f"SELECT {EVENT_OUT} FROM rep")
    S["q_replicate_files"] = files_sql(True, f"WHERE last_updated_time <= {RUN_MS}")
    S["q_replicate_files_metadata"] = files_sql(
        False, f"WHERE last_updated_time <= {RUN_MS} AND last_updated_time > {DELTA_MARK_MS - 3600000}")
    S["q_replicate_labels"] = q("""
SELECT external_id, name, description, data_set_id, CAST(NULL AS BIGINT) AS created_time FROM src_labels""",
                                "src_labels")
    S["q_replicate_raw"] = q("""
SELECT db_name, table_name, key, last_updated_time, columns_text AS columns FROM src_raw""", "src_raw")
    S["q_replicate_relationships"] = q(f"""
SELECT r.external_id, r.source_external_id, r.source_type, r.target_external_id, r.target_type, r.start_time,
       r.end_time, {R6('r.confidence')} AS confidence, tdm.tid AS data_set_id, {ARR('r.labels')} AS labels,
       CAST(NULL AS BIGINT) AS created_time, CAST(NULL AS BIGINT) AS last_updated_time
FROM src_relationships r {ds_remap('r')}
WHERE r.data_set_id IN (SELECT id FROM src_data_sets WHERE external_id IN ('ds:AFRICA', 'ds:AMERICA', 'ds:EUROPE'))""",
                                       "src_relationships", "src_data_sets", maps=("sdm", "tdm"))
    seq_filter = "NOT coalesce(h.external_id IN ('seq:1', 'seq:2', 'seq:3', 'seq:100'), false)"
    seq_cols = ("array_to_string(list_transform(h.columns, lambda c: c.name || ':' || c.external_id || ':' || "
                "c.description || ':' || c.value_type), ';')")
    S["q_replicate_sequence_headers"] = q(f"""
SELECT CAST(NULL AS BIGINT) AS id, coalesce(h.external_id, CAST(h.id AS VARCHAR)) AS external_id, h.name,
       h.description, tam.tid AS asset_id, {KV('h.metadata')} AS metadata, {seq_cols} AS columns,
       CAST(NULL AS BIGINT) AS created_time, CAST(NULL AS BIGINT) AS last_updated_time, tdm.tid AS data_set_id
FROM seq_headers h LEFT JOIN sam ON sam.id = h.asset_id
LEFT JOIN tam ON tam.ext = coalesce(sam.ext, CAST(h.asset_id AS VARCHAR)) {ds_remap('h')}
WHERE {seq_filter}""", "seq_headers", maps=("sam", "tam", "sdm", "tdm"))
    S["q_replicate_sequence_rows"] = q(f"""
SELECT coalesce(h.external_id, CAST(h.id AS VARCHAR)) AS seq_external_id, r.row_number,
       r.c_qty || ',' || r.c_price || ',' || r.c_flag || ',' || r.c_late AS values
FROM seq_rows r JOIN seq_headers h ON r.id = h.id WHERE {seq_filter}""", "seq_rows", "seq_headers")
    ts_filter = """
NOT (coalesce(h.external_id IN ('ts:25'), false) OR coalesce(regexp_full_match(h.external_id, 'ts:.*7'), false))
AND (coalesce(h.external_id IN ('ts:1', 'ts:3'), false) OR coalesce(regexp_full_match(h.external_id, 'ts:2.*'), false)
     OR coalesce(regexp_full_match(h.external_id, 'ts:1[0-9]'), false))"""
    S["q_replicate_ts_headers"] = q(f"""
SELECT CAST(NULL AS BIGINT) AS id, coalesce(h.external_id, CAST(h.id AS VARCHAR)) AS external_id, h.name,
       h.description, h.is_string, h.is_step, h.unit, tam.tid AS asset_id, '' AS security_categories,
       CAST(NULL AS BIGINT) AS created_time, CAST(NULL AS BIGINT) AS last_updated_time, tdm.tid AS data_set_id,
       {KV('h.metadata')} AS metadata
FROM ts_headers h LEFT JOIN sam ON sam.id = h.asset_id
LEFT JOIN tam ON tam.ext = coalesce(sam.ext, CAST(h.asset_id AS VARCHAR)) {ds_remap('h')}
WHERE {ts_filter}""", "ts_headers", maps=("sam", "tam", "sdm", "tdm"))
    w2 = _win(flt.window_config_days(RUN_TIME, 2)).replace("timestamp", "p.timestamp")
    clamp = ("CASE WHEN p.value_string IS NULL THEN CASE WHEN isnan(p.value) THEN p.value WHEN p.value > 1e100 "
             "THEN 1e100 WHEN p.value < -1e100 THEN -1e100 ELSE p.value END END")
    rep_points = f"""
SELECT coalesce(p.external_id, CAST(p.id AS VARCHAR)) AS external_id, p.timestamp, {clamp} AS value, p.value_string
FROM ts_points p JOIN ts_headers h ON p.id = h.id WHERE {w2} AND {ts_filter}"""
    S["q_replicate_ts_points"] = q(f"""
SELECT external_id, timestamp, {R6('value')} AS value, value_string FROM ({rep_points})""", "ts_points", "ts_headers")
    # ------------------------------------------------------------- sinks
    delta = f"WHERE last_updated_time <= {RUN_MS} AND last_updated_time > {DELTA_MARK_MS - 2 * 3600000}"
    S["q_upsert_events"] = replicate_events_sql(delta, f"""
SELECT {EVENT_OUT} FROM (
  SELECT * FROM tgt_events WHERE external_id NOT IN (SELECT external_id FROM rep WHERE external_id IS NOT NULL)
  UNION ALL BY NAME SELECT * FROM rep)""")
    S["q_upsert_points"] = q(f"""
WITH_SRC AS (SELECT 1)
SELECT external_id, timestamp, {R6('value')} AS value, value_string FROM (
  SELECT * FROM (SELECT coalesce(external_id, CAST(id AS VARCHAR)) AS external_id, timestamp, value * 2 AS value,
                        value_string FROM ts_points WHERE timestamp % 2 = 0) t
  WHERE NOT EXISTS (SELECT 1 FROM ({rep_points}) s WHERE s.external_id = t.external_id AND s.timestamp = t.timestamp)
  UNION ALL SELECT * FROM ({rep_points}))""".replace("WITH_SRC AS (SELECT 1)\n", ""), "ts_points", "ts_headers")
    S["q_points_by_day"] = f"""SELECT *, strftime(epoch_ms(timestamp), '%Y-%m-%d') AS p_date FROM ({S['q_upsert_points']})"""
    S["q_events_by_key"] = S["q_upsert_events"]
    S["q_upsert_raw"] = q("""
SELECT db_name, table_name, key, last_updated_time, columns_text AS columns FROM (
  SELECT db_name, table_name, key, last_updated_time - 86400000 AS last_updated_time, columns_text
  FROM src_raw WHERE db_name = 'geo'
  UNION ALL SELECT db_name, table_name, key, last_updated_time, columns_text FROM src_raw WHERE db_name = 'sales')""",
                          "src_raw")
    S["q_hierarchy_diff"] = q("SELECT external_id, root_external_id, op FROM diff", *A,
                              maps=("sam", "sdm", "tdm"), extra=PREPARED_ASSETS.strip())
    S["q_hierarchy_sync"] = q(f"""
SELECT n.external_id, n.name, n.parent_external_id, n.root_external_id, n.description, n.data_set_id,
       {ARR('n.labels')} AS labels, {KV('n.metadata')} AS metadata, n.created_time, n.last_updated_time,
       (n.parent_external_id IS NULL OR n.parent_external_id IN (SELECT external_id FROM synced)) AS parent_resolved,
       (n.root_external_id IN (SELECT external_id FROM synced)) AS root_resolved
FROM synced n""", *A, maps=("sam", "sdm", "tdm"), extra=PREPARED_ASSETS.strip() + f""",
synced AS (
  SELECT external_id, name, parent_external_id, root_external_id, description, data_set_id, labels, metadata,
         created_time, last_updated_time
  FROM ta WHERE root_external_id NOT IN (SELECT root_external_id FROM scope)
             AND external_id NOT IN (SELECT external_id FROM pa)
  UNION ALL
  SELECT pa.external_id, pa.name, pa.parent_external_id, pa.root_external_id, pa.description, pa.data_set_id,
         pa.labels, pa.metadata, coalesce(tin.created_time, {RUN_MS}),
         CASE WHEN d.op = 'unchanged' THEN tin.last_updated_time ELSE {RUN_MS} END
  FROM pa JOIN diff d ON d.external_id = pa.external_id LEFT JOIN tin ON tin.external_id = pa.external_id
  WHERE d.op <> 'delete')""")
    S["q_run_counters"] = q("""
SELECT 'events_missing_external_id' AS counter, CAST(count(*) FILTER (WHERE external_id IS NULL) AS BIGINT) AS value
FROM src_events
UNION ALL SELECT 'events_assets_mapped', CAST(count(*) AS BIGINT) FROM amap WHERE len(mapped) > 0
UNION ALL SELECT 'events_data_set_mapped', CAST(count(*) FILTER (WHERE tdm.tid IS NOT NULL) AS BIGINT)
  FROM src_events e LEFT JOIN sdm ON sdm.id = e.data_set_id
  LEFT JOIN tdm ON tdm.ext = coalesce(sdm.ext, CAST(e.data_set_id AS VARCHAR))
UNION ALL SELECT 'events_data_set_not_mapped', CAST(count(*) FILTER (WHERE tdm.tid IS NULL) AS BIGINT)
  FROM src_events e LEFT JOIN sdm ON sdm.id = e.data_set_id
  LEFT JOIN tdm ON tdm.ext = coalesce(sdm.ext, CAST(e.data_set_id AS VARCHAR))
UNION ALL SELECT 'assets_root', CAST(count(*) FILTER (WHERE pm.ext IS NULL) AS BIGINT)
  FROM src_assets a LEFT JOIN sam pm ON pm.id = a.parent_id
UNION ALL SELECT 'files_forward_slash', CAST(count(*) FILTER (WHERE contains(coalesce(name, ''), '/')) AS BIGINT) FROM src_files
UNION ALL SELECT 'files_back_slash', CAST(count(*) FILTER (WHERE contains(coalesce(name, ''), '\\')) AS BIGINT) FROM src_files
UNION ALL SELECT 'files_cleaned', CAST(count(*) FILTER (WHERE translate(coalesce(name, ''), '/\\', '--') <> coalesce(name, ''))
  AS BIGINT) FROM src_files
UNION ALL SELECT 'files_labels_removed', CAST(sum(len(f.labels) - len(coalesce(lk.kept, CAST([] AS VARCHAR[])))) AS BIGINT)
  FROM src_files f LEFT JOIN lk ON lk.id = f.id""", "src_events", "src_assets", "tgt_assets", "src_files",
                            "tgt_labels", "src_data_sets", "tgt_data_sets", maps=("sam", "tam", "sdm", "tdm"),
                            extra=asset_array_remap("src_events").strip() + """,
lel AS (SELECT id, unnest(labels) AS l, generate_subscripts(labels, 1) AS pos FROM src_files),
lk AS (SELECT id, list(l ORDER BY pos) AS kept FROM lel WHERE l IN (SELECT external_id FROM tgt_labels) GROUP BY id)""")
    S["q_written_events"] = S["q_publish_events"]
    S["q_written_points"] = f"""SELECT *, substr(timestamp, 1, 10) AS p_date FROM ({S['q_publish_ts_points']})"""
    S["q_written_sequence_bodies"] = S["q_publish_sequence_bodies"]
    S["q_text_export"] = f"""SELECT line FROM ({S['q_text_lines']}) WHERE external_id = '{EXPORT_SERIES}' AND timestamp >= {DELTA_MARK_MS}"""
    S["q_sequences_job"] = S["q_replicate_sequence_rows"]
    S["q_files_job"] = S["q_replicate_files"]
    S["q_ts_job_flags"] = f"""
SELECT * FROM (VALUES ('no', CAST(-1 AS BIGINT), (SELECT count(*) FROM ({S['q_replicate_ts_points']}))),
                      ('YES', (SELECT count(*) FROM ({S['q_replicate_ts_headers']})), CAST(-1 AS BIGINT)),
                      ('maybe', CAST(-1 AS BIGINT), CAST(-1 AS BIGINT))) x(setting, n_headers, n_points)"""
    S["q_job_counters"] = S["q_run_counters"]
    S["q_stream_hour_rollup"] = q("""
SELECT id, hour, count(value) AS count, round(min(value), 6) AS min, round(max(value), 6) AS max,
       round(sum(value), 6) AS sum, round(avg(value), 6) AS average
FROM (SELECT CAST(7000000 + e.user_id AS BIGINT) AS id,
             (epoch_us(e.ts) // 1000) - ((epoch_us(e.ts) // 1000) % 3600000) AS hour, e.value
      FROM events e JOIN ts_headers h ON h.id = 7000000 + e.user_id WHERE NOT h.is_string)
GROUP BY id, hour""", "ts_headers")
    return S


def oracle_sql() -> dict[str, str]:
    return build()
