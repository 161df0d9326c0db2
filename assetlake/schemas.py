"""Declared schemas of the 13 published tables (Spark DDL)."""

from __future__ import annotations

KV = "array<struct<key:string,value:string>>"

PUBLISHED: dict[str, str] = {
    "assets": ("id bigint, external_id string, name string, parent_id bigint, parent_external_id string, "
               "description string, root_id bigint, source string, created_time timestamp, "
               f"last_updated_time timestamp, data_set_id bigint, labels array<string>, metadata {KV}, "
               "child_count bigint, depth bigint, path array<bigint>, row_updated_time timestamp"),
    "data_sets": (f"id bigint, external_id string, name string, description string, metadata {KV}, "
                  "write_protected boolean, created_time timestamp, last_updated_time timestamp, "
                  "row_updated_time timestamp"),
    "events": ("id bigint, external_id string, start_time timestamp, end_time timestamp, description string, "
               "type string, subtype string, source string, asset_ids array<bigint>, created_time timestamp, "
               f"last_updated_time timestamp, data_set_id bigint, metadata {KV}, row_updated_time timestamp"),
    "files": ("id bigint, external_id string, source_created_time timestamp, source_modified_time timestamp, "
              "name string, directory string, mime_type string, source string, asset_ids array<bigint>, "
              "security_categories array<bigint>, labels array<string>, uploaded boolean, "
              "uploaded_time timestamp, created_time timestamp, last_updated_time timestamp, "
              f"data_set_id bigint, metadata {KV}, row_updated_time timestamp"),
    "labels": ("external_id string, name string, description string, data_set_id bigint, "
               "created_time timestamp, row_updated_time timestamp"),
    "raw": (f"db_name string, table_name string, row_key string, last_updated_time timestamp, columns {KV}, "
            "row_updated_time timestamp"),
    "relationships": ("external_id string, source_external_id string, source_type string, "
                      "target_external_id string, target_type string, start_time timestamp, "
                      "end_time timestamp, confidence double, data_set_id bigint, labels array<string>, "
                      "created_time timestamp, last_updated_time timestamp, row_updated_time timestamp"),
    "sequence_columns": ("name string, external_id string, seq_external_id string, description string, "
                         f"value_type string, metadata {KV}, created_time timestamp, "
                         "last_updated_time timestamp, row_updated_time timestamp"),
    "sequence_headers": ("id bigint, name string, description string, asset_id bigint, external_id string, "
                         f"metadata {KV}, columns array<struct<name:string,external_id:string,value_type:string>>, "
                         "created_time timestamp, last_updated_time timestamp, data_set_id bigint, "
                         "row_updated_time timestamp"),
    "sequence_rows": f"seq_external_id string, row_number bigint, rows {KV}, row_updated_time timestamp",
    "ts_headers": ("id bigint, external_id string, name string, description string, is_string boolean, "
                   "is_step boolean, unit string, asset_id bigint, security_categories array<bigint>, "
                   "created_time timestamp, last_updated_time timestamp, data_set_id bigint, "
                   f"metadata {KV}, row_updated_time timestamp"),
    "ts_points": ("id bigint, external_id string, timestamp timestamp, value double, value_string string, "
                  "row_updated_time timestamp"),
    "ts_points_hour": ("id bigint, external_id string, timestamp timestamp, average double, max double, "
                       "min double, count bigint, sum double, interpolation double, step_interpolation double, "
                       "continuous_variance double, discrete_variance double, total_variation double, "
                       "row_updated_time timestamp"),
}
PUBLISHED["sequence_bodies"] = PUBLISHED["sequence_rows"]  # the same table, read from nested bodies
