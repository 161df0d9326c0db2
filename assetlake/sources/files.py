"""A5: file bodies, read apart from the metadata and attached last.

Metadata runs narrow through all filters, joins and the choice of the newest row of a key; bodies are read once
and meet only the rows that are left. Small metadata is broadcast to the bodies, which then move through no
shuffle; beyond the size check both meet in one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import sized_dim


def path_key(directory: str = "directory", name: str = "name"):
    """The path of a file below its tenant's folder: directory and name, without outer or doubled slashes."""
    whole = F.concat_ws("/", F.coalesce(F.col(directory), F.lit("")), F.coalesce(F.col(name), F.lit("")))
    return F.regexp_replace(F.regexp_replace(whole, "/+", "/"), "^/|/$", "")


def binary_bodies(spark: SparkSession, content_dir: str, glob: str = "*") -> DataFrame:
    """(path, content) of every file below ``content_dir``, by its full path below that folder.

    Spark's file listing leaves files of no bytes out, so they count as files without a body.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(content_dir)
    root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(content_dir)
    return found.select(F.substring("path", len(root) + 2, 1 << 20).alias("path"), "content")


def attach_bodies(files: DataFrame, bodies: DataFrame, key: str, max_bytes: int | None = None) -> DataFrame:
    """``files`` with the ``content`` of ``bodies`` (key, content); NULL where there is no body or no key.

    ``bodies`` holds a key once; rows of ``files`` may share one.
    """
    narrow, small = sized_dim(files, max_bytes=max_bytes)
    if not small:
        return narrow.join(bodies, key, "left")
    # the bodies' side is read twice, but the second time its keys alone
    found = bodies.join(narrow, key)
    missing = narrow.join(bodies.select(key), key, "left_anti").withColumn("content", F.lit(None).cast("binary"))
    return found.select(*files.columns, "content").unionByName(missing.select(*files.columns, "content"))


def files_with_content(spark: SparkSession, metadata: DataFrame, content_dir: str, glob: str = "*") -> DataFrame:
    """File metadata (directory, name, ...) with the bodies stored below ``content_dir`` under the same path."""
    keyed = metadata.withColumn("__path", path_key())
    bodies = binary_bodies(spark, content_dir, glob).withColumnRenamed("path", "__path")
    return attach_bodies(keyed, bodies, "__path").drop("__path")
