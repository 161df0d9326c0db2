import hashlib
import os

import duckdb
import pytest
from pyspark.sql import Row

from assetlake.llm import exact_dedup as X
from assetlake.llm.common import fresh_path, settle, store

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, keep_id int"


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = X.q_exact_dedup(spark, SF)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({X.Q_SQL})").fetchall()
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want)


def test_edges_and_clashing_columns(spark):
    rows = [(1, None, None, None, None, "x", 1), (2, "", "", None, None, None, None), (3, "Ab", None, None, None, None, 0),
            (9, "aB", None, None, None, None, 0), (5, "É", None, None, None, None, 0), (6, "é", None, None, None, None, 0),
            (7, "z" * 300_000, None, None, None, None, 0), (7, "z" * 300_000, None, None, None, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in X.dedup(df, X.DigestIndex(spark, fresh_path(spark, "i"))).collect()}
    assert got == {(1, 2, 2, False), (2, 2, 2, True), (3, 9, 2, False), (9, 9, 2, True), (5, 5, 1, True), (6, 6, 1, True),
                   (7, 7, 2, True)}
    assert sorted(r.doc_id for r in X.stage(spark, df, SF).collect()) == [2, 5, 6, 7, 9]


def test_empty(spark):
    assert X.dedup(spark.createDataFrame([], SCHEMA), X.DigestIndex(spark, fresh_path(spark, "i"))).count() == 0


def test_second_batch_is_deduplicated_against_the_index(spark):
    path = fresh_path(spark, "i")
    X.dedup(spark.createDataFrame([Row(doc_id=1, text="one"), Row(doc_id=2, text="two")]), X.DigestIndex(spark, path), "a").count()
    again = X.DigestIndex(spark, path)
    second = X.dedup(spark.createDataFrame([Row(doc_id=8, text="TWO"), Row(doc_id=9, text="new")]), again, "b")
    got = {r.doc_id: (r.keep_id, r.kept, r.seen_before, r.text_sha256) for r in second.collect()}
    assert got[8][:3] == (2, False, True) and got[9][:3] == (9, True, False)
    assert got[9][3] == hashlib.sha256(b"new").hexdigest()
    assert again.rows().count() == 3
    plan = again.unseen(spark.createDataFrame([Row(digest=bytearray(b"a"))]))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


def documents(spark, ids):
    return spark.createDataFrame([Row(doc_id=k, text=f"text {k}") for k in ids])


def test_index_reopened_under_other_settings_knows_its_digests(spark):
    path, before = fresh_path(spark, "i"), spark.conf.get("spark.sql.shuffle.partitions")
    assert X.dedup(documents(spark, range(500)), X.DigestIndex(spark, path, 8), "a").where("kept").count() == 500
    try:
        for n, buckets in ((5, None), (16, None), (8, 32)):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            spark.sql(f"DROP TABLE IF EXISTS {X.DigestIndex(spark, path).name}")  # a new session knows no such table
            index = X.DigestIndex(spark, path, buckets)
            assert index.buckets == 8
            got = X.dedup(documents(spark, range(500)), index, f"again {n}")
            assert got.where("kept").count() == 0 and index.rows().count() == 500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_digests_without_layout_are_refused(spark):
    path = fresh_path(spark, "i")
    X.dedup(documents(spark, range(3)), X.DigestIndex(spark, path), "a")
    spark.createDataFrame([(1,)], "x int").write.parquet(other := fresh_path(spark, "o"))
    with pytest.raises(ValueError):
        X.DigestIndex(spark, other)


def test_a_batch_run_again_gets_its_first_answer(spark):
    index = X.DigestIndex(spark, fresh_path(spark, "i"))
    X.dedup(documents(spark, range(0, 60)), index, "a")
    first = sorted(map(tuple, X.dedup(documents(spark, range(40, 100)), index, "b").collect()))  # appended, its result never written
    again = sorted(map(tuple, X.dedup(documents(spark, range(40, 100)), index, "b").collect()))
    assert first == again and sum(r[3] for r in again) == 40 and index.rows().count() == 100
    assert X.dedup(documents(spark, range(100)), index).where("kept").count() == 0


def test_a_crash_before_the_append_loses_nothing(spark, monkeypatch):
    index = X.DigestIndex(spark, fresh_path(spark, "i"))

    def lost(groups, batch):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(index, "append", lost)
        with pytest.raises(OSError):
            X.dedup(documents(spark, range(10)), index, "a")
    assert X.dedup(documents(spark, range(10)), index, "a").where("kept").count() == 10


def test_stage_decides_by_id_and_text(spark):
    """A doc_id that repeats loses only the text that another row repeats; whole repeated rows stay once."""
    df = spark.createDataFrame([(5, "A", 1), (5, "b", 2), (9, "B", 3), (9, "B", 3), (None, "c", 4), (3, None, 5)], "doc_id long, text string, digest int")
    out = X.stage(spark, df, SF)
    assert out.dtypes == df.dtypes
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [(5, "A", 1), (9, "B", 3), (None, "c", 4), (3, None, 5)]))


def test_settle_leaves_the_result_alone(spark):
    seen = []

    def make():
        seen.append(store(spark.range(5), "part"))
        seen.append(settle(lambda: store(seen[0], "inner").where("id > 1"), "within"))
        return seen[1].where("id > 2")

    out = settle(make, "whole")
    assert sorted(r.id for r in out.collect()) == [3, 4]
    there = lambda df: os.path.exists(df.stored_path.removeprefix("file:"))
    assert there(out) and not any(map(there, seen))
