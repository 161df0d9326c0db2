import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from assetlake.llm import packing as P

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_cost(pos, penalty, size):
    cost = [0.0]
    for j in range(1, len(pos)):
        options = []
        for i in range(j):
            n = pos[j] - pos[i]
            if n <= size:
                options.append(cost[i] + (0 if n & (n - 1) == 0 and n >= P.SMALLEST_POWER else size - n) + penalty[j])
        cost.append(min(options))
    return cost[-1]


def paid(cuts, pos, penalty, size):
    by, total, at = dict(zip(pos, penalty, strict=True)), 0.0, 0
    for c in cuts:
        n = c - at
        total += (0 if n & (n - 1) == 0 and n >= P.SMALLEST_POWER else size - n) + by[c]
        at = c
    return total


def test_cuts_are_optimal():
    rng = random.Random(9)
    for _ in range(200):
        size = rng.choice([256, 300, 1024])
        pos, penalty = [0], [0.0]
        for _ in range(rng.randrange(1, 60)):
            pos.append(pos[-1] + rng.randrange(1, size // 3))
            penalty.append(rng.choice([0.0, 8.0, 32.0]))
        cuts = P.choose_cuts(pos, penalty, size)
        assert cuts[-1] == pos[-1]
        assert paid(cuts, pos, penalty, size) == brute_cost(pos, penalty, size)


@pytest.mark.parametrize("block", [200, 5000])
def test_stream_keeps_every_id_in_order(block):
    rng = np.random.default_rng(1)
    ends = np.zeros(100, bool)
    ends[7] = True
    docs = [(i, np.append(rng.integers(3, 100, n).astype(np.uint32), np.uint32(2))) for i, n in enumerate([0, 5, 3000, 64, 1, 900, 40, 40])]
    pieces = list(P.pack_stream(docs, ends, size=64, block=block))
    assert np.array_equal(np.concatenate([p[2] for p in pieces]), np.concatenate([d for _, d in docs]))
    room = {}
    for doc, start, ids, total, seq, offset in pieces:
        assert room.get(seq, 0) == offset and np.array_equal(docs[doc][1][start:start + len(ids)], ids) and total == len(docs[doc][1])
        room[seq] = offset + len(ids)
    assert max(room.values()) <= 64 and sorted(room) == list(range(len(room)))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert P.tokenizer(PATH).encode(text).tolist() == LIB.encode(text, add_special_tokens=False).ids + [2]


LIB = Tokenizer.from_file(PATH)
CASES = ["ΑΣ Σ", "İstanbul", "J̌ á", "<|endoftext|> <|ENDOFTEXT|>", "don't I'LL we've", "a\x1cb\x1d c\x85d\xa0e", "x" * 3000, "ab12 3.14 (foo). \"Bar!\"", "É é", "\n\n a \t b"]


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    assert P.tokenizer(PATH).encode(text).tolist() == LIB.encode(text, add_special_tokens=False).ids + [2]


def test_small_cache(monkeypatch):
    monkeypatch.setattr(P, "CACHE_WORDS", 20)
    monkeypatch.setattr(P, "BLOCK_CHARS", 100)
    t = P.Tokenizer(PATH)
    text = " ".join(f"word{i} other. more{'x' * (i % 7)}, letters" for i in range(200))
    for _ in range(2):
        assert t.encode(text).tolist() == LIB.encode(text, add_special_tokens=False).ids + [2]


def test_query(spark):
    rows = P.q_packing(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, t in texts.items():
        ids = np.array(LIB.encode(t, add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    used = padded = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        used += at
        padded += at if at & (at - 1) == 0 else 4096
    print("padding", 1 - used / padded)
    assert used >= 0.97 * padded


def test_nulls_and_clashes(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (None, "a b", 5), (2, "", 5)], "doc_id long, text string, start int")
    got = P.pack(df, PATH).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        by.setdefault(r.doc_id, []).extend(r.ids)
    assert by == {1: [2], 2: [2, 2], None: LIB.encode("a b", add_special_tokens=False).ids + [2]}
    assert P.pack(df.limit(0), PATH).count() == 0


def test_batches_are_bounded_by_their_ids():
    pieces = [(k, 0, np.zeros(4096 if k % 3 else 10, np.uint32), 1, k, 0) for k in range(5000)]
    for with_ids, most in ((True, P.BLOCK_TOKENS + P.SIZE), (False, 2048 * P.SIZE)):
        found = list(P.batched(iter(pieces), with_ids))
        assert [p[0] for rows in found for p in rows] == list(range(5000))
        assert all(len(rows) <= 2048 and sum(len(p[2]) for p in rows) <= most for rows in found)
    assert len(list(P.batched(iter(pieces), False))) == 3 and list(P.batched(iter([]), True)) == []
