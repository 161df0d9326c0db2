"""Scalar column functions (time, text, values, dynamic cells).

All of these return native Spark ``Column`` expressions, so they run inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The largest instant the published tables accept
# (9999-12-31T23:59:59.99Z) and the point-value clamp bound.
MAX_TIMESTAMP_MS = 253402300799990
VALUE_BOUND = 1e100
DESCRIPTION_LIMIT = 500


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------- time
def millis_to_ts(c) -> Column:
    """K1: epoch millis -> timestamp (NULL stays NULL)."""
    return F.timestamp_millis(col(c))


def iso_instant(ms) -> Column:
    """K2: epoch millis -> ISO-8601 instant text; fraction only when non-zero."""
    ts = F.timestamp_millis(col(ms))
    return (F.when(F.pmod(col(ms), F.lit(1000)) == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")))


def cap_end_time(c) -> Column:
    """K6: clamp an epoch-millis end time to the largest accepted instant (NULL-safe)."""
    c = col(c)
    return F.when(c > F.lit(MAX_TIMESTAMP_MS), F.lit(MAX_TIMESTAMP_MS)).otherwise(c)


# ---------------------------------------------------------------------- values
def clamp_value(c) -> Column:
    """K7: clamp a double to +-1e100; infinities clamp, NaN passes unchanged."""
    v = col(c)
    return (F.when(F.isnan(v), v)
            .when(v > F.lit(VALUE_BOUND), F.lit(VALUE_BOUND))
            .when(v < F.lit(-VALUE_BOUND), F.lit(-VALUE_BOUND))
            .otherwise(v))


def ext_id_fallback(ext, id_) -> Column:
    """External id, or the internal id as text when missing."""
    return F.coalesce(col(ext), col(id_).cast("string"))


def non_blank(c) -> Column:
    """Key usable for external-id lookups: not NULL and not empty."""
    c = col(c)
    return c.isNotNull() & (c != "")


# ------------------------------------------------------------------------ text
def full_match(c, pattern: str) -> Column:
    """The whole value matches ``pattern`` (Java ``Pattern.matches``).

    ``\\A`` / ``\\z`` anchor at the true start and end; ``$`` would also
    accept a match that stops before a trailing newline.
    """
    return col(c).rlike(r"\A(?:" + pattern + r")\z")


def clean_file_name(c) -> Column:
    """Replace '/' and '\\' by '-'."""
    return F.translate(col(c), "/\\", "--")


def truncate_text(c, n: int = DESCRIPTION_LIMIT) -> Column:
    return F.substring(col(c), 1, n)


# ---------------------------------------------------------------- nested values
def map_to_kv(c) -> Column:
    """I4: map<string,string> -> array<struct<key,value>> (never NULL)."""
    return F.coalesce(
        F.transform(F.map_entries(col(c)), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))),
        F.array().cast("array<struct<key:string,value:string>>"))


def put_metadata(m, key: str, value) -> Column:
    """Add or overwrite one metadata key (works on a NULL map too)."""
    m = F.coalesce(col(m), F.create_map().cast("map<string,string>"))
    v = value if isinstance(value, Column) else F.lit(value)
    return F.map_concat(F.map_filter(m, lambda k, _: k != F.lit(key)), F.create_map(F.lit(key), v))


def empty_if_null(c, ddl: str) -> Column:
    return F.coalesce(col(c), F.array().cast(ddl))


# -------------------------------------------------------------- dynamic values
def cell_text(v) -> Column:
    """Sequence cell -> text. number / string / bool printed, other kinds ''."""
    v = col(v)
    return (F.when(v["kind"] == "number", v["num"].cast("string"))
            .when(v["kind"] == "string", v["str"])
            .when(v["kind"] == "bool", v["bool"].cast("string"))
            .otherwise(F.lit("")))


def dynamic_text(v) -> Column:
    """Raw column value -> text. strings verbatim, everything else as JSON."""
    v = col(v)
    return (F.when(v["kind"] == "string", v["str"])
            .when(v["kind"] == "number", v["num"].cast("string"))
            .when(v["kind"] == "bool", v["bool"].cast("string"))
            .when(v["kind"] == "null", F.lit("null"))
            .otherwise(v["json"]))
