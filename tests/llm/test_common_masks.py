import pytest

from assetlake.llm import common as C
from assetlake.llm import exact_dedup as X
from assetlake.llm import minhash_dedup as M


def test_masks_find_every_key_and_lose_no_row(spark):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(2000)] + [(None, "n"), (7, "again")], "doc_id long, text string")
    keys = spark.createDataFrame([(i,) for i in range(0, 2000, 50)] + [(None,), (7,), (7,), (99999,)], "k int")
    some = C.among(rows, "doc_id", keys)
    found = [r.doc_id for r in some.collect()]
    assert {*range(0, 2000, 50), 7, None} <= set(found) and found.count(7) == 2 and len(found) < 100
    named, others = C.apart(rows, "doc_id", keys)
    assert named.columns == others.columns == some.columns == rows.columns
    assert sorted(map(str, named.collect())) == sorted(map(str, some.collect()))
    assert sorted(map(str, named.unionByName(others).collect())) == sorted(map(str, rows.collect()))
    none = keys.where("k < 0")
    assert C.among(rows, "doc_id", none).isEmpty() and C.apart(rows, "doc_id", none)[1].count() == rows.count()


def shuffled(df) -> int:
    """Most rows that an exchange of ``df`` wrote, as counted while it ran."""
    df.write.mode("overwrite").format("noop").save()
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().executedPlan().execute().count()
    found, todo = [0], [plan]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        elif name == "ShuffleExchangeExec":
            found.append(int(p.metrics().apply("shuffleRecordsWritten").value()))
        kids = p.children()
        todo += [kids.apply(k) for k in range(kids.size())]
    return max(found)


@pytest.mark.parametrize("step", [X.stage, M.stage, lambda spark, docs, _: M._full_sets(docs.where("doc_id < 12").select(docs.doc_id.alias("id")).distinct(), docs)])
def test_texts_of_documents_without_copies_are_not_shuffled(spark, step, monkeypatch):
    made = []
    if step not in (X.stage, M.stage):
        monkeypatch.setattr(M, "store", lambda df, name: made.append(shuffled(df)) or C.store(df, name))
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    docs = C.store(spark.createDataFrame([(i, text(i if i > 9 else 0)) for i in range(3000)], "doc_id long, text string"), "many")
    put = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(put[0], "-1")  # as with too many keys to broadcast
    try:
        out = step(spark, docs, None)
        assert max(made or [shuffled(out)]) < 200
        assert out.count() == (12 if made else 2991)
    finally:
        spark.conf.set(*put)
