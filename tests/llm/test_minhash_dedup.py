import random
import re

import numpy as np

from assetlake.llm import minhash_dedup as M

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, sig string, set_id int, id long"


def brute(rows):
    """doc_id -> (n_shingles, component_id) from all pairs that share a shingle, by their exact sets."""
    sets = {}
    for i, t in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    common = {}
    for ids in where.values():
        for p in range(len(ids)):
            for q in range(p):
                k = (min(ids[p], ids[q]), max(ids[p], ids[q]))
                common[k] = common.get(k, 0) + 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def result(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = M.q_minhash_dedup(spark, SF)
    assert got.count() == len(rows)
    assert result(got) == brute(rows)


def test_chains_whose_ends_are_unlike(spark):
    """Each document shares 80 % with the next only: linked through the chain, though the smallest is unlike the last."""
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}" for _ in range(1200)]
    order = list(range(12))
    rng.shuffle(order)
    rows = [(i, " ".join(words[k * 40:k * 40 + 500])) for k, i in enumerate(order)]
    rows += [(100 + i, " ".join(f"u{i}_{rng.randrange(10**6)}" for _ in range(60))) for i in range(20)]
    assert result(M.near_components(spark.createDataFrame([(i, t, "x", 1, 5) for i, t in rows], SCHEMA))) == brute(rows)


def test_edges(spark):
    long = " ".join(f"a{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One Two"), (5, "one two"), (6, "one\ttwo"), (7, "one two"), (8, long), (9, long + " x"), (10, "É a"), (11, "é a")]
    df = spark.createDataFrame([(i, t, None, None, 7) for i, t in rows] + [(7, "one two", None, None, 7), (None, "one two", None, None, None)], SCHEMA)
    out = M.near_components(df)
    assert out.count() == 13
    got = result(out)
    assert got.pop(None) == (1, None)
    assert got == brute(rows)
    assert M.near_components(df.limit(0)).count() == 0
    assert {r.doc_id for r in M.stage(spark, df, SF).collect()} == {1, 2, 3, 4, 8, 10, 11, None}


def test_bayes_prunes_little_at_the_threshold():
    rng = np.random.default_rng(0)
    left = rng.integers(0, 1 << 32, (20_000, M.HASHES), dtype=np.uint32)
    for share, least, most in ((0.75, 0.9999, 1), (0.3, 0, 0.01)):
        right = np.where(rng.random(left.shape) < share, left, left + np.uint32(1))
        assert least <= M.passes(left, right).mean() <= most


def test_cells_find_what_the_star_leaves_out(spark, monkeypatch):
    monkeypatch.setattr(M, "CELL", 2)
    test_chains_whose_ends_are_unlike(spark)


def test_rounds_go_on_until_no_survivor_is_left_over(spark, monkeypatch):
    """Two groups of near copies, unlike the smallest document of their buckets in part: few survivors a round, same result."""
    monkeypatch.setattr(M, "FIRST", 1)
    monkeypatch.setattr(M, "GROWTH", 2)
    monkeypatch.setattr(M, "CELL", 4)
    rng = random.Random(9)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(300), 4 + i % 9):
            words[k] = f"x{i}_{k}"
        rows.append((i, " ".join(words)))
    assert result(M.near_components(spark.createDataFrame([(i, t, "x", 1, 5) for i, t in rows], SCHEMA))) == brute(rows)


def test_pairs_just_below_the_threshold_are_not_all_handed_on(spark, monkeypatch):
    """A component and as many documents a little too unlike it: its pairs are checked, but only a few a document become rows."""
    seen, verify = [], M._verify
    monkeypatch.setattr(M, "_verify", lambda pairs, docs: seen.append(pairs.count()) or verify(pairs, docs))
    rng = random.Random(5)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(240):
        words = list(base)
        for k in rng.sample(range(2, 298, 6), 3 if i % 2 else 8):
            words[k] = f"x{i}_{k}"
        rows.append((i, " ".join(words)))
    got = result(M.near_components(spark.createDataFrame([(i, t, "x", 1, 5) for i, t in rows], SCHEMA)))
    assert got == brute(rows)
    assert sum(seen[1:]) < 20 * len(rows), seen  # of 14,400 pairs of the two kinds


def test_common_counts_over_slices(monkeypatch):
    monkeypatch.setattr(M, "COLUMNS", 3)
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (0, 1, 5, 30, 80, 80)]
    p, q = np.divmod(np.arange(36), 6)
    assert M.common(sets, p, q).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(p, q, strict=True)]


def test_cells_hand_on_fewer_links_than_they_have_members():
    """Documents that are near the threshold to one another, each a component of its own: all pairs survive, and all or none are links."""
    rng = np.random.default_rng(6)
    for shared, links in ((84, 0), (90, 119)):  # of 100 shingles: similarity 0.72 and 0.82
        common_ = rng.integers(0, 1 << 63, shared, dtype=np.uint64)
        sets = [np.unique(np.concatenate((common_, rng.integers(0, 1 << 63, 100 - shared, dtype=np.uint64)))) for _ in range(120)]
        sig = np.stack([M.signature(s) for s in sets])
        probe, comp, order = np.arange(240) < 120, np.tile(np.arange(120) * 7, 2), np.tile(np.arange(120), 2)
        p, q = next(M._slices(probe, comp, 240))
        assert len(M.survivors(sig[order], sig[order], p, q)[0]) > 100 * 120
        a, b = M.cell_links(probe, comp, sig[order], [sets[k] for k in order])
        assert len(a) == links
        root = list(range(120))
        assert len(M._join(root, order[a], order[b])) == links
