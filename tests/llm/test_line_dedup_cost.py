import re
import time

from pyspark.sql import functions as F

from assetlake.llm import line_dedup as X

HUGE = 8000  # bytes of code of a method; longer ones the JVM leaves to its interpreter


def longest_method(spark, df) -> int:
    debug = spark._jvm.org.apache.spark.sql.execution.debug.package
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(df._jdf.queryExecution().executedPlan())))


def test_generated_code_is_short_enough_to_be_compiled(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a line of some length\nanother line")], "doc_id long, text string")
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sigs = X.signatures(X.lines(docs))
        assert longest_method(spark, sigs) <= HUGE
        sigs.write.parquet(f"{tmp_path}/sigs")
        spark.range(2).select(F.col("id").alias("a"), F.col("id").alias("b")).write.parquet(f"{tmp_path}/pairs")
        pairs = X.likely(spark.read.parquet(f"{tmp_path}/pairs"), spark.read.parquet(f"{tmp_path}/sigs"))
        assert longest_method(spark, pairs) <= HUGE
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_hashes_of_a_long_line_take_time_in_proportion_to_it(spark, tmp_path):
    spark.createDataFrame([("ab" * 300_000,)], "line string").write.parquet(f"{tmp_path}/long")
    began = time.time()
    row = spark.read.parquet(f"{tmp_path}/long").select(F.size(X._hashes(F.col("line"))).alias("n")).first()
    assert row.n == 600_000 - X.SHINGLE + 1
    assert time.time() - began < 10
