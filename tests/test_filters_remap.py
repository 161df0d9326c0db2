"""Allow/deny semantics (D1-D5, Q1, Q15) and foreign-key remapping."""


from assetlake.operators import filters as flt
from assetlake.operators import remap


def _keys(df, col="k"):
    return sorted([r[col] for r in df.collect()], key=lambda x: (x is None, x))


def test_allow_deny(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    assert _keys(df.filter(flt.allow_deny("k", [], []))) == []                  # empty allow => nothing
    assert _keys(df.filter(flt.allow_deny("k", ["*"], ["b"]))) == ["a", "c", None]
    assert _keys(df.filter(flt.allow_deny("k", ["a", "b"], ["b"]))) == ["a"]   # deny wins


def test_allow_deny_long_lists_use_joins(spark):
    df = spark.createDataFrame([(str(i),) for i in range(20)], "k string")
    allow = [str(i) for i in range(0, 2000, 2)]
    deny = ["4"] + [f"x{i}" for i in range(10)]
    got = _keys(flt.allow_deny_frame(df, "k", allow, deny))
    assert got == sorted(str(i) for i in range(0, 20, 2) if i != 4)


def test_regex_allow_deny(spark):
    df = spark.createDataFrame([(x,) for x in ["ts:1", "ts:12", "ts:17", "ts:2", "ts:25", "xts:12", None]], "k string")
    f = flt.regex_allow_deny("k", ["ts:2"], ["ts:1.*"], ["ts:25"], [".*7"])
    # partial regex matches do not pass; exact and regex allow are unioned
    assert _keys(df.filter(f)) == ["ts:1", "ts:12", "ts:2"]
    assert _keys(df.filter(flt.regex_allow_deny("k", ["*"], [], [], []))) == \
        ["ts:1", "ts:12", "ts:17", "ts:2", "ts:25", "xts:12", None]


def test_data_set_filter_empty_or_star_keeps_all(spark):
    ds = spark.createDataFrame([(1, "ds:a"), (2, "ds:b")], "id long, external_id string")
    df = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "x long, data_set_id long")
    assert df.transform(lambda d: flt.data_set_filter(d, ds, [])).count() == 3
    assert df.transform(lambda d: flt.data_set_filter(d, ds, ["*", "ds:a"])).count() == 3
    assert _keys(flt.data_set_filter(df, ds, ["ds:b"]), "x") == [11]


def test_windows():
    lo, hi = flt.window_previous_hour("2024-01-30T12:34:56Z")
    assert (hi - lo) == (34 * 60 + 56 + 70 * 60) * 1000
    assert flt.window_config_days("2024-01-30T12:34:56Z", -1)[0] == 31536000000
    lo2, _ = flt.window_config_days("2024-01-30T12:34:56Z", 2)
    assert lo2 == flt.to_ms("2024-01-27T23:00:00Z")


def test_remap_array_keeps_order_duplicates_and_empty(spark):
    src = spark.createDataFrame([(1, "A"), (2, "B"), (3, None), (4, "")], "id long, external_id string")
    tgt = spark.createDataFrame([(100, "A"), (200, "B"), (300, "3"), (400, "")], "id long, external_id string")
    tr = remap.translation(src, tgt)
    # 3 has no source ext id -> looked up as "3"; 4 has a blank ext id -> "4" not at target
    assert sorted(tuple(r) for r in tr.collect()) == [(1, 100), (2, 200), (3, 300)]
    facts = spark.createDataFrame([(10, [2, 1, 2, 9]), (11, []), (12, None), (13, [4, 3])],
                                  "id long, asset_ids array<bigint>")
    out = {r["id"]: r["asset_ids"] for r in remap.remap_array(facts, "id", "asset_ids", tr).collect()}
    assert out == {10: [200, 100, 200], 11: [], 12: [], 13: [300]}


def test_keep_known_labels_keeps_order_and_duplicates(spark):
    known = spark.createDataFrame([("a",), ("c",)], "external_id string")
    facts = spark.createDataFrame([(1, ["c", "x", "a", "c"]), (2, ["x"])], "id long, labels array<string>")
    out = {r["id"]: r["labels"] for r in remap.keep_known(facts, "id", "labels", known).collect()}
    assert out == {1: ["c", "a", "c"], 2: []}


def test_scalar_remap_unmapped_is_null(spark):
    tr = spark.createDataFrame([(1, 10)], "src_id long, tgt_id long")
    df = spark.createDataFrame([(1,), (2,), (None,)], "data_set_id long")
    got = sorted([r[0] for r in remap.remap_scalar(df, "data_set_id", tr).collect()], key=lambda x: (x is None, x))
    assert got == [10, None, None]


def test_salted_join_equals_plain_join(spark):
    from assetlake.operators.joins import salted_join
    fact = spark.createDataFrame([(i, 1 if i % 3 else i) for i in range(300)], "row long, k long")
    dim = spark.createDataFrame([(k, k * 10) for k in range(0, 300, 3)] + [(1, 10)], "dk long, v long")
    plain = fact.join(dim, fact.k == dim.dk).select("row", "v")
    salted = salted_join(fact, dim, "k", "dk", 8).select("row", "v")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))


def test_remap_array_salted_when_not_broadcast(spark, monkeypatch):
    from assetlake.operators import joins
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    calls = []
    real = remap.salted_join
    monkeypatch.setattr(remap, "salted_join", lambda *a, **k: calls.append(1) or real(*a, **k))
    src = spark.createDataFrame([(1, "A"), (2, "B")], "id long, external_id string")
    tgt = spark.createDataFrame([(100, "A"), (200, "B")], "id long, external_id string")
    tr = remap.translation(src, tgt)
    facts = spark.createDataFrame([(i, [1, 2, 1]) for i in range(50)], "id long, asset_ids array<bigint>")
    out = {r["id"]: r["asset_ids"] for r in
           remap.map_array(facts, "id", "asset_ids", tr.selectExpr("src_id AS k", "tgt_id AS v"), salts=4,
                           ).collect()}
    assert all(v == [100, 200, 100] for v in out.values()) and len(out) == 50
    assert calls, "the salted join path was not taken"
