"""Driver tables (TPC-H-like star schema + events + pages) as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy accessor: ``t("lineitem")`` is a parquet scan of that table.

    Parquet timestamps without zone load as ``timestamp_ntz``; they are cast
    once to session-zone (UTC) ``timestamp`` so epoch-millis arithmetic works.
    The cast is a projection, so column pruning and filter pushdown still
    reach the scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        cols = []
        for f in df.schema.fields:
            if isinstance(f.dataType, T.TimestampNTZType):
                cols.append(F.col(f.name).cast("timestamp").alias(f.name))
            else:
                cols.append(F.col(f.name))
        return df.select(*cols)
