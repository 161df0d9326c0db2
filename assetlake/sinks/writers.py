"""Table writers: overwrite with an asserted schema, day partitioning,
clustering (B1-B3) and delimited text export (B4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .partitioned import replace_table


class SchemaMismatch(ValueError):
    pass


def assert_schema(df: DataFrame, expected: T.StructType | str) -> DataFrame:
    """B1: the published table must have exactly the declared columns and types."""
    if isinstance(expected, str):
        expected = T._parse_datatype_string(expected)
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    if got != want:
        raise SchemaMismatch(f"schema mismatch:\n got  {got}\n want {want}")
    return df


def layout(df: DataFrame, partition_col: str | None = None, cluster_by: list[str] | None = None) -> DataFrame:
    """Add ``p_date`` from a timestamp column and range-cluster rows.

    Rows are range-partitioned on (p_date, cluster columns) and sorted within
    each partition, so every output file covers a narrow key range and
    Parquet min/max statistics prune well for the clustered columns. The
    range bounds come from a sample, so the sort never gathers one key's
    rows into a single task beyond what a range can hold.
    """
    keys: list = []
    if partition_col:
        df = df.withColumn("p_date", F.to_date(F.col(partition_col)))
        keys.append("p_date")
    keys += list(cluster_by or [])
    if keys:
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return df


def overwrite(df: DataFrame, path: str, expected_schema: T.StructType | str | None = None,
              partition_col: str | None = None, cluster_by: list[str] | None = None) -> None:
    """Create-or-replace a Parquet table (optionally day-partitioned); readers see the old or the new one."""
    if expected_schema is not None:
        assert_schema(df, expected_schema)
    out = layout(df, partition_col, cluster_by)
    w = out.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy("p_date")
    replace_table(df.sparkSession, path, w.parquet)


def write_lines(lines: DataFrame, path: str, header: str, single_file: bool = False) -> None:
    """Finished text lines with a header line per file, written as they are (no quoting, no escaping).

    Sharded by default (one file per partition). A single file funnels all rows
    through one task and is meant for small exports such as one series.
    """
    out = lines.toDF(header)
    w = (out.coalesce(1) if single_file else out).write.mode("overwrite").options(
        header=True, sep="\u0001", quote="\u0000", emptyValue="", ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False, extension="txt")
    replace_table(lines.sparkSession, path, w.csv)
