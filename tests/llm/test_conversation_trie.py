import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from assetlake.llm import conversation_trie as T
from assetlake.llm.common import store

SCHEMA = "conv_id long, turn long, role string, text string, depth string, digest int, words array<int>"
WORD = re.compile("[^\x20\x09-\x0d]+")


def sequences(rows):
    """Turns of each conversation; rows of equal turn numbers must be equal here."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append(((t is not None, t or 0), (r or "", x or "")))
    return {c: [said for _, said in sorted(v, key=lambda p: p[0])] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    return out


def nodes(convs):
    """Brute force: a dictionary of every prefix."""
    members = defaultdict(list)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, ids in members.items():
        own = (len(ids) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += own
    return sorted(((min(ids), len(p), -1 if not p else min(members[p[:-1]]), len(ids), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(p)).encode()).hexdigest()) for p, ids in members.items()))


def result(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *r[3:]) for r in df.select(*T.COLUMNS).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, [2]) for r in rows], SCHEMA)


def both_ways(spark, rows):
    df = frame(spark, rows)
    assert result(T.trie(df)) == nodes(sequences(rows))
    parts = store(T.share_heads(T.pieces(store(T.turn_digests(df), "t"))), "p")
    assert result(T.trie_of(parts)) == nodes(rebuilt(sequences(rows)))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(T.q_conversation_trie(spark, f"/root/testdata/{sf}")) == nodes(rebuilt(sequences(rows)))


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.01/conversations.parquet'")
    want = con.execute(f"SELECT {', '.join(T.COLUMNS)} FROM ({T.Q_SQL})").fetchall()
    assert result(T.q_conversation_trie(spark, "/root/testdata/sf0.01")) == sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in want)


def random_rows(rng, convs=60, alphabet="abc", most=6):
    return [(c, t, rng.choice(["u", None, "a"]), rng.choice(alphabet) * rng.randrange(1, 3) + rng.choice(["", " w\tw", "  "]))
            for c in range(convs) for t in range(rng.randrange(1, most))]


@pytest.mark.parametrize("seed", range(2))
def test_small_shards_and_segments(spark, monkeypatch, seed):
    monkeypatch.setattr(T, "SHARD_TURNS", 7)
    monkeypatch.setattr(T, "SEGMENT", 2)
    rng = random.Random(seed)
    rows = random_rows(rng)
    rows += [(100 + c, t, "u", "same") for c in range(40) for t in range(3)]  # copies over many shards
    rows += [(200 + c, t, "u", "long" if t < 90 - 30 * c else f"{c}") for c in range(3) for t in range(100)]  # long shared heads
    rows += [(300, t, "u", f"{t % 5}") for t in range(301)]  # a long one of its own
    rows += [(320, t, "u", "x") for t in range(70)] + [(321, t, "u", "x") for t in range(70)]  # long copies
    rng.shuffle(rows)
    both_ways(spark, rows)


def test_nulls_ties_repeats_negative_ids_and_one_column_of_text(spark):
    rows = [(1, None, None, None), (1, 0, "u", ""), (1, 1, "", "u"), (2, 5, "u", "a b"), (2, 5, "u", "a b"), (None, 1, "u", "gone"),
            (3, -4, "u", "a b"), (3, 9, "u", "a b"), (-7, 1, "u", "z"), (-25, 1, "u", "z"), (-20, 0, "s", "q r"), (20, 1, "u", "w " * 200_000), (21, 1, "u", "w " * 200_000)]
    both_ways(spark, rows)
    got = T.trie(frame(spark, [(1, 1, "u", "b"), (1, 1, "u", "a")]))
    assert got.count() == 3 and result(got) == result(T.trie(frame(spark, [(1, 1, "u", "a"), (1, 1, "u", "b")])))


def test_empty(spark):
    assert T.trie(frame(spark, [])).count() == 0
    assert T.trie_of(store(T.share_heads(T.pieces(T.turn_digests(frame(spark, [])))), "p")).count() == 0


def test_tree_is_balanced_by_median_insertion():
    assert sorted(T.median_order(1000)) == list(range(1000))
    tree = T.Tree()
    for k in T.median_order(1023):
        tree.insert([k, k % 3], [1, 1])

    def height(x):
        return 0 if x < 0 else 1 + max(height(tree.low[x]), height(tree.high[x]))
    assert height(tree.below[0]) == 10
