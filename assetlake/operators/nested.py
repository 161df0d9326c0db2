"""Sequence bodies: records nested in their sequence.

A body is ``(id, external_id, columns array<struct<external_id>>, rows array<struct<row_number, values>>)``: one
row a sequence, or a page of one. A sequence of any length may come in several bodies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BODY_DDL = ("id bigint, external_id string, columns array<struct<external_id:string>>, rows array<struct<row_number:bigint,"
            "values:array<struct<kind:string,num:double,str:string,bool:boolean,json:string>>>>")


def records(body: DataFrame) -> DataFrame:
    """One row a record (id, external_id, columns, row_number, values), the body's columns repeated.

    Bodies with NULL or no rows give none, a NULL record is left out.
    """
    one = body.select("id", "external_id", "columns", F.explode("rows").alias("record")).where("record IS NOT NULL")
    return one.select("id", "external_id", "columns", "record.row_number", "record.values")


def last_record(body: DataFrame) -> DataFrame:
    """H2: per body the number of records and the row number of the last one (NULL without any)."""
    return body.select("id", "external_id", F.coalesce(F.array_size("rows"), F.lit(0)).cast("long").alias("n_records"),
                       F.try_element_at("rows", F.lit(-1))["row_number"].alias("last_row_number"))
