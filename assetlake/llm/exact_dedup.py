"""Exact dedup against a persistent digest index.

``DigestIndex`` is a Parquet table bucketed and sorted by digest. A batch of
documents is reduced to one row per digest (map-side partial aggregation, 32
bytes a document), deduplicated by a sort-merge anti-join with the index (the
bucketed side isn't shuffled) and the new digests are appended.

Defined results: NULL text counts as empty, and empty texts equal each other;
texts are equal when identical after lower-casing A-Z; of equal texts in a
batch the largest doc_id stays (a NULL doc_id only when no other is there),
unless the index already holds the digest: then its document stays and the
whole batch group is dropped. Rows that repeat a doc_id and text carry the
same flag. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.common import _delete, apart, fresh_path, lower_ascii, settle, store, table, unclash


class DigestIndex:
    """Digests seen so far: (digest binary, keep_id long, batch string).

    The number of buckets is fixed when the index is made and stored with it (``_layout``): files dealt into other
    buckets than the catalog declares would hide known digests from the anti-join.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        store_ = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        layout = f"{path}/_layout"
        if not store_.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{layout}/_SUCCESS")):
            if store_.exists(at) and any(s.getPath().getName().startswith("part-") for s in store_.listStatus(at)):
                raise ValueError(f"{path} holds digests, but not their number of buckets")
            wanted = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.createDataFrame([(wanted,)], "buckets int").write.mode("overwrite").parquet(layout)
        self.buckets = spark.read.schema("buckets int").parquet(layout).first()[0]
        self.name = "digest_index_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex
        # Bucketing lives in the catalog: a new session declares the same table over the same folder.
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, batch STRING) "
                  f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame, batch: str | None = None) -> DataFrame:
        """Groups whose digest isn't in the index (sort-merge anti-join); what ``batch`` itself appended doesn't count."""
        return groups.join(self.others(batch).select("digest").hint("merge"), "digest", "left_anti")

    def others(self, batch: str | None) -> DataFrame:
        """The rows that other batches appended."""
        return self.rows() if batch is None else self.rows().where(F.col("batch") != batch)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Append one row per digest, one sorted file per bucket; digests that this batch appended before are left."""
        mine = self.rows().where(F.col("batch") == batch).select("digest").hint("merge")
        (groups.select("digest", "keep_id", F.lit(batch).alias("batch")).join(mine, "digest", "left_anti")
         .repartition(self.buckets, "digest")
         .write.mode("append").insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)

    def drop(self) -> None:
        """Remove the index, its files and its catalog entry."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        _delete(self.spark, self.path)


def digest_of(text):
    return F.unhex(F.sha2(lower_ascii(text).cast("binary"), 256))


def digests(docs: DataFrame) -> DataFrame:
    return unclash(docs, ["doc_id", "text"]).select("doc_id", digest_of(F.col("text")).alias("digest"))


def dedup(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """Decide for every row of ``docs`` and append its new digests to ``index``.

    A batch with a name can be run again, after a crash at any point too: it gets the answer of its first run and
    adds nothing twice. Returns doc_id, keep_id, group_size (rows of this batch with the digest),
    kept, text_sha256, seen_before.
    """
    batch = batch or uuid.uuid4().hex
    narrow = store(digests(docs), "digests")
    groups = store(narrow.groupBy("digest").agg(F.max("doc_id").alias("keep_id"),
                                                F.count(F.lit(1)).alias("group_size")), "digest-groups")
    new = store(index.unseen(groups, batch).withColumn("seen_before", F.lit(False)), "digest-new")
    old = (groups.join(new.select("digest"), "digest", "left_anti").drop("keep_id")
           .join(index.others(batch).select("digest", "keep_id").hint("merge"), "digest")
           .select("digest", "keep_id", "group_size", F.lit(True).alias("seen_before")))
    decided = store(new.unionByName(old), "digest-decided")
    index.append(new, batch)
    # Copies of one text meet here; the decided table is a plain file, so AQE can split a hot digest.
    return narrow.join(decided, "digest").select(
        "doc_id", "keep_id", "group_size",
        (~F.col("seen_before") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "seen_before")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of equal texts stays.

    Only rows whose doc_id goes, or is repeated with its text, are compared with the decisions; the texts of all others
    aren't moved.
    """
    index = DigestIndex(spark, fresh_path(spark, "digest-index"))
    said = settle(lambda: dedup(docs, index).groupBy("doc_id", F.unhex("text_sha256").alias("digest"))
                  .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("not kept or n > 1"), "digest-said")
    index.drop()
    named, others = apart(docs, "doc_id", said.select("doc_id"))
    named = named.withColumn("__digest", digest_of(F.col("text")))

    def meet(rows: DataFrame, which: str, how: str) -> DataFrame:
        keys = said.where(which).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__d"))
        return rows.join(keys, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__d")), how)

    if said.where("kept").isEmpty():
        stay = meet(named, "not kept", "left_anti")
    else:
        stay = meet(named, "true", "left_anti").unionByName(meet(named, "kept", "left_semi").dropDuplicates(["doc_id", "__digest"]))
    return others.unionByName(stay.drop("__digest"))


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, fresh_path(spark, "digest-index"))
    return dedup(table(spark, sf_dir, "documents"), index).drop("seen_before")


Q_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM t
"""
