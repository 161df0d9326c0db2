"""Sequence bodies: records nested in their sequence."""

from assetlake.operators.nested import BODY_DDL, last_record, records
from assetlake.plans import jobs
from assetlake.plans import replicate as R
from assetlake.plans.params import RUN_TIME, cfg_sequences
from assetlake.sources.scan import ParquetTenant, materialize


def cell(kind, num=None, s=None):
    return (kind, num, s, None, None)


def test_empty_null_and_short_bodies(spark):
    cols = [("a",), ("b",)]
    body = spark.createDataFrame([
        (1, "s1", cols, [(0, [cell("number", 1.0), cell("string", s="x")]), (7, [cell("number", 2.0)]), (8, None), None]),
        (2, "s2", cols, []), (3, None, cols, None), (4, "s4", None, [(1, [cell("null")])]),
        (1, "s1", cols, [(9, [])]),  # a second page of a sequence
    ], BODY_DDL)
    got = sorted((r.id, r.external_id, r.row_number, None if r["values"] is None else len(r["values"])) for r in records(body).collect())
    assert got == [(1, "s1", 0, 2), (1, "s1", 7, 1), (1, "s1", 8, None), (1, "s1", 9, 0), (4, "s4", 1, 1)]
    assert sorted((r.id, r.n_records, r.last_row_number or -1) for r in last_record(body).collect()) == [(1, 1, 9), (1, 4, -1), (2, 0, -1), (3, 0, -1), (4, 1, 1)]

    class Tenant:
        def sequence_body(self):
            return body

        def sequence_headers(self):
            return spark.createDataFrame([(1,), (3,)], "id long")
    out = sorted((r.seq_external_id, r.row_number, tuple((c.key, c.value) for c in r.rows)) for r in jobs.PUBLISH["sequence_bodies"](Tenant(), RUN_TIME).collect())
    assert out == [("s1", 0, (("a", "1.0"), ("b", "x"))), ("s1", 7, (("a", "2.0"), ("b", ""))), ("s1", 8, (("a", ""), ("b", ""))),
                   ("s1", 9, (("a", ""), ("b", "")))]


def test_published_and_replicated_from_a_stored_tenant(spark, tenants, tmp_dir):
    src, _ = tenants
    materialize(src, f"{tmp_dir}/t", ("sequence_body", "sequence_headers", "data_sets"))
    stored = ParquetTenant(spark, f"{tmp_dir}/t")
    jobs.run_publish("sequence_bodies", stored, f"{tmp_dir}/out", RUN_TIME)
    flat = records(src.sequence_body())
    assert spark.read.parquet(f"{tmp_dir}/out").count() == flat.count() > 0
    rep = R.prepare_sequence_rows(stored, cfg_sequences(), nested=True)
    known = R.filtered_sequence_headers(src, cfg_sequences()).select("id")
    assert rep.count() == flat.join(known, "id").count() > 0
    assert {"external_id", "last_row_number"} <= set(last_record(stored.sequence_body()).columns)
