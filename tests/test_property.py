"""Operators against brute-force Python on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assetlake.operators import remap
from assetlake.operators.hierarchy import path_depth_children
from assetlake.operators.rules import event_rules

SETTINGS = dict(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# ---------------------------------------------------------------- hierarchy
@st.composite
def forests(draw):
    n = draw(st.integers(1, 30))
    parents = {}
    for i in range(1, n + 1):
        # parent: none (root), an earlier node, a later node (may form cycles) or a missing id
        parents[i] = draw(st.one_of(st.none(), st.integers(1, n), st.just(999)))
    return parents


def brute_hierarchy(parents):
    out = {}
    for node in parents:
        path, cur, seen = [], node, set()
        while cur is not None and cur in parents and cur not in seen:
            seen.add(cur)
            path.append(cur)
            cur = parents[cur]
        reached_root = cur is None
        out[node] = (len(path) - 1, list(reversed(path))) if reached_root else (None, None)
    children = {}
    for c, p in parents.items():
        if p is not None:
            children[p] = children.get(p, 0) + 1
    return {k: (d, p, children.get(k, 0)) for k, (d, p) in out.items()}


@settings(**SETTINGS)
@given(parents=forests())
def test_hierarchy_matches_brute_force(spark, parents):
    df = spark.createDataFrame(list(parents.items()), "id long, parent_id long")
    got = {r["id"]: (r["depth"], r["path"], r["child_count"]) for r in path_depth_children(df).collect()}
    assert got == brute_hierarchy(parents)


# -------------------------------------------------------------------- remap
ext = st.one_of(st.none(), st.just(""), st.sampled_from(["A", "B", "C", "1", "2", "7"]))


@settings(**SETTINGS)
@given(src=st.dictionaries(st.integers(1, 8), ext, max_size=8),
       tgt=st.dictionaries(ext.filter(lambda e: e is not None), st.integers(100, 120), max_size=6),
       facts=st.lists(st.lists(st.integers(1, 9), max_size=5), min_size=1, max_size=6))
def test_array_remap_matches_lookup(spark, src, tgt, facts):
    s = spark.createDataFrame([(k, v) for k, v in src.items()] or [(0, None)], "id long, external_id string")
    t = spark.createDataFrame([(v, k) for k, v in tgt.items()] or [(0, None)], "id long, external_id string")
    f = spark.createDataFrame(list(enumerate(facts)), "id long, asset_ids array<bigint>")
    got = {r["id"]: r["asset_ids"] for r in
           remap.remap_array(f, "id", "asset_ids", remap.translation(s, t)).collect()}
    src_map = {k: v for k, v in src.items() if v}          # blank external ids are dropped
    tgt_map = {k: v for k, v in tgt.items() if k}
    for i, ids in enumerate(facts):
        want = [tgt_map[src_map.get(a, str(a))] for a in ids if src_map.get(a, str(a)) in tgt_map]
        assert got[i] == want


# -------------------------------------------------------------------- rules
def brute_rules(start, end, desc):
    """The reference's sequential repair rules on proto-style values (unset reads as 0 / "")."""
    meta = {}
    has_s, has_e = start is not None, end is not None
    s, e = (start or 0), (end or 0)
    if s < 0:
        s, has_s = 0, True
        meta["constraintViolationStartTime_b"] = 1
    if e < 0:
        e, has_e = s, True
        meta["constraintViolationEndTime_b"] = 1
    if has_s and has_e and s > e:
        s = e
        meta["constraintViolationStartTime_b"] = 2
    d = desc or ""
    if len(d) > 500:
        d = d[:500]
        meta["constraintViolationDescription"] = 1
    return (s if has_s else None, e if has_e else None, d if desc is not None else None, set(meta))


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), st.integers(-5, 5)),
                               st.one_of(st.none(), st.integers(0, 3).map(lambda n: "x" * (499 + n)))),
                     min_size=1, max_size=20))
def test_event_rules_match_sequential_logic(spark, rows):
    df = spark.createDataFrame([(i, s, e, d, {}) for i, (s, e, d) in enumerate(rows)],
                               "id long, start_time long, end_time long, description string, metadata map<string,string>")
    got = {r["id"]: (r["start_time"], r["end_time"], r["description"], set(r["metadata"]))
           for r in event_rules(df).collect()}
    for i, (s, e, d) in enumerate(rows):
        assert got[i] == brute_rules(s, e, d), (s, e, d)


# ---------------------------------------------------------- hierarchy diff
from assetlake.operators.hierarchy import hierarchy_diff  # noqa: E402

assets = st.dictionaries(st.sampled_from([f"a{i}" for i in range(12)]),
                         st.tuples(st.sampled_from(["R1", "R2", "R3"]), st.sampled_from(["x", "y"])),
                         max_size=10)


def brute_diff(src, tgt):
    scope = {root for root, _ in src.values()}
    ops = {}
    for ext, (root, name) in src.items():
        if ext not in tgt:
            ops[ext] = "create"
        else:
            ops[ext] = "unchanged" if tgt[ext] == (root, name) else "update"
    for ext, (root, _) in tgt.items():
        if ext not in src and root in scope:
            ops[ext] = "delete"
    return ops


@settings(**SETTINGS)
@given(src=assets, tgt=assets)
def test_hierarchy_diff_matches_brute_force(spark, src, tgt):
    schema = ("external_id string, root_external_id string, name string, parent_external_id string, "
              "description string, source string, data_set_id long, labels array<string>, "
              "metadata map<string,string>")

    def frame(d):
        return spark.createDataFrame([(e, r, n, None, None, None, None, [], {}) for e, (r, n) in d.items()]
                                     or [("__none", "__none", "", None, None, None, None, [], {})], schema) \
            .filter("external_id <> '__none'")

    got = {r["external_id"]: r["op"] for r in hierarchy_diff(frame(src), frame(tgt)).collect()}
    assert got == brute_diff(src, tgt)


# ------------------------------------------------------------------ upsert
from assetlake.sinks.upsert import upsert  # noqa: E402

rows_kv = st.dictionaries(st.one_of(st.none(), st.sampled_from("abcdefgh")), st.integers(0, 9), max_size=8)


@settings(**SETTINGS)
@given(tgt=rows_kv, src=rows_kv)
def test_upsert_matches_dict_replace(spark, tgt, src):
    t = spark.createDataFrame([(k, v, "old") for k, v in tgt.items()], "k string, v long, w string")
    s = spark.createDataFrame([(k, v) for k, v in src.items()], "k string, v long")
    key = lambda r: (r[0], r[1], r[2] or "")
    got = sorted(((r["k"] or "", r["v"], r["w"]) for r in upsert(t, s, ["k"]).collect()), key=key)
    # NULL keys never match, so a NULL-keyed target row survives next to a NULL-keyed source row
    want = [(k or "", v, "old") for k, v in tgt.items() if k is None or k not in src]
    want += [(k or "", v, None) for k, v in src.items()]
    assert got == sorted(want, key=key)
