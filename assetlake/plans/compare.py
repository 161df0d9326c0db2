"""Scalar "comparison form" of a result, shared by the query registry.

Published tables carry timestamps, arrays and key/value arrays; an engine
independent check wants plain scalars. The rules (mirrored in the SQL of
``oracle.py``):

* timestamp          -> 'yyyy-MM-dd HH:mm:ss.SSS' (UTC)
* array<key/value>   -> 'k=v;k=v' sorted by key
* map<string,string> -> same as key/value arrays
* array<struct>      -> fields joined by ':' per element, elements by ';'
* array<scalar>      -> elements joined by ',' (order kept)
* double             -> rounded to 6 decimals
* int / smallint     -> bigint
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def _is_kv(st: T.StructType) -> bool:
    return [f.name for f in st.fields] == ["key", "value"]


def flat_column(name: str, dt: T.DataType):
    c = F.col(f"`{name}`")
    if isinstance(dt, T.TimestampType):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return F.round(c.cast("double"), DIGITS)
    if isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("bigint")
    if isinstance(dt, T.MapType):
        return kv_text(F.map_entries(c))
    if isinstance(dt, T.ArrayType):
        et = dt.elementType
        if isinstance(et, T.StructType) and _is_kv(et):
            return kv_text(c)
        if isinstance(et, T.StructType):
            return F.array_join(F.transform(c, lambda e: F.concat_ws(
                ":", *[F.coalesce(e[f.name].cast("string"), F.lit("")) for f in et.fields])), ";")
        return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return c


def kv_text(c):
    return F.array_join(F.transform(F.array_sort(c), lambda e: F.concat(
        e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), ";")


def for_compare(df: DataFrame) -> DataFrame:
    return df.select(*[flat_column(f.name, f.dataType).alias(f.name) for f in df.schema.fields])
