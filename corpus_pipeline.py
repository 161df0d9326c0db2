"""Corpus pipeline: language ID, exact dedup, near-dedup, secret scan, packing.

``STAGES`` are applied in order; each stage's result is written as Parquet to the
shared scratch folder and read back as the next one's documents. All but the last
return the columns of ``documents``; the last returns pieces of training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assetlake.llm import exact_dedup, langid, minhash_dedup, packing, secret_scan
from assetlake.llm.common import store, table

STAGES = [
    ("language_id", langid.stage),
    ("exact_dedup", exact_dedup.stage),
    ("minhash_dedup", minhash_dedup.stage),
    ("secret_scan", secret_scan.stage),
    ("packing", packing.stage),
]

#: language, near-dedup, secret and packing decisions aren't expressible in SQL; tests/llm holds the brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
