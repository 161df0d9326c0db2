import hashlib
import random

import numpy as np
import pytest

from assetlake.llm import suffix_dedup as X

SF = "/root/testdata/sf0.01"


def brute(rows, n):
    """doc -> (bytes, removed, spans, digest), from all windows of all texts."""
    count = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, d in data:
        for p in range(len(d) - n + 1):
            k = hash(d[p:p + n])
            count[k] = count.get(k, 0) + 1
    out = []
    for i, d in data:
        cover = np.zeros(len(d) + 1, int)
        for p in range(len(d) - n + 1):
            if count[hash(d[p:p + n])] > 1:
                cover[p] += 1
                if p + n <= len(d):
                    cover[p + n] -= 1
        gone = np.cumsum(cover[:len(d)]) > 0
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()) if len(d) else 0
        rest = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((i, len(d), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows, X.MIN_BYTES)
    assert sum(r[2] > 0 and r[2] < r[1] for r in want) > 5
    assert result(X.q_suffix_dedup(spark, SF)) == want


@pytest.mark.parametrize("seed,n,mean", [(1, 40, 8), (2, 60, 20), (3, 90, 8)])
def test_random_repeats(spark, seed, n, mean):
    """Passages pasted at any place and cut anywhere, runs of one letter, periodic texts, copies that overlap themselves."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdeé ") for _ in range(k))
    shared = [word(rng.randrange(n // 2, 5 * n)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            parts += [word(rng.randrange(0, 2 * n)), s[a:a + rng.randrange(len(s))]]
        rows.append((i, "".join(parts)))
    rows += [(100, "a" * (3 * n)), (101, "ab" * n), (102, word(n)), (103, "a" * n), (104, rows[0][1]), (105, None), (106, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(X.dedup(df, n, mean)) == brute(rows, n)


def test_edges(spark):
    rng = random.Random(8)
    long = "".join(rng.choice("abcdefgh ") for _ in range(150_000))
    rows = [(1, None, 0, "x"), (2, "short", 1, "x"), (3, long, 2, "x"), (3, long[1000:1500] + "!", 3, "x"), (None, "é" * 150, 4, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, uid int, digest string")
    assert result(X.dedup(df)) == brute([r[:2] for r in rows], 400)
    assert X.dedup(df.limit(0)).count() == 0
    spans = {r.n_bytes: r.spans for r in X.dedup(df, with_rest=True).collect()}
    assert spans[150_000] == [[1000, 1500]] and spans[501] == [[0, 500]]
