import numpy as np
import pytest

from assetlake.llm import forest_dedup as R

SCHEMA = "vec_id long, embedding array<float>, label int, cls string, m int"


def brute(rows):
    good = [(i, np.array(v, np.float64), lab) for i, v, lab in rows
            if v is not None and lab is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = set()
    for p, (a, x, la) in enumerate(good):
        for b, y, lb in good[:p]:
            if la == lb and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                pairs.add((b, a))
                links[a] += 1
                links[b] += 1
                u, w = sorted((top(a), top(b)))
                root[w] = u
    return {i: (links[i], top(i)) for i in links}, pairs


def result(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("leaf", [256, 16])
def test_against_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(R, "LEAF", leaf)
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rng = np.random.default_rng(2)
    top = max(r[0] for r in rows) + 1
    for k, r in enumerate(rows[:60]):  # near and exact copies, around the threshold
        v = np.array(r[1]) + rng.standard_normal(len(r[1])) * np.linalg.norm(r[1]) * 0.02 * (k % 3)
        rows.append((top + k, [float(np.float32(x)) for x in v], r[2]))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = {r.vec_id: r for r in R.near_vectors(df).collect()}
    want, pairs = brute(rows)
    assert len(got) == len(rows)
    found, there = sum(r.n_links for r in got.values()), 2 * len(pairs)
    print("recall", found / max(1, there), there)
    assert there > 50 and 0.9 * there <= found <= there
    assert all(got[i].n_links <= want[i][0] and got[i].component_id >= want[i][1] for i in want)
    assert sum(got[i].component_id == want[i][1] for i in want) >= 0.98 * len(want)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, 0.0], None),
            (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0], 1), (11, [1.0, 0.0], 2), (12, [1.0, 0.0, 0.0], 1), (13, [1.0, -0.0], 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = result(R.near_vectors(df))
    assert got == {**{i: (0, i) for i in (1, 2, 3, 4, 5, 6, 7, 11, 12)}, 8: (3, 8), 9: (3, 8), 10: (3, 8), 13: (3, 8)}
    assert R.near_vectors(df.limit(0)).count() == 0


def test_tight_cluster_larger_than_a_leaf(spark, monkeypatch):
    monkeypatch.setattr(R, "LEAF", 8)
    monkeypatch.setattr(R, "CELL", 16)
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    rows = [(i, [float(np.float32(x)) for x in base + rng.standard_normal(16) * 0.01], 1) for i in range(80)]
    got = result(R.near_vectors(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)))
    assert got == brute(rows)[0]
