import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from assetlake.llm import sentencepiece_codec as C

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return C.codec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(both, text):
    c, sp = both
    ids = sp.encode(text) + [sp.eos_id()]
    assert c.encode(text) == ids
    assert c.decode(ids) == sp.decode(ids)


CASES = ["", " ", "  a  b ", "\n", "a\nb\t", "é　x ﬁ", "▁a▁▁b", "a\x00b", "<s>a</s><0x41>", "x" * 5000, "ab" * 3000,
         " " * 100, "日本語テキスト🙂🙂", "é", "aaaaaaaaaaaab" * 50, "!!!???...,,,", "http://a.b/c?d=e&f=%20", "1234567890" * 40]


@pytest.mark.parametrize("text", CASES)
def test_cases(both, text):
    same(both, text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80))
def test_any_text(both, text):
    text = text.encode("utf-8", "ignore").decode()
    same(both, text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aeionrstlhd .,\n▁'=-", max_size=120))
def test_word_like_text(both, text):
    same(both, text)


def test_decode_any_ids(both):
    c, sp = both
    rng = random.Random(5)
    for _ in range(300):
        ids = [rng.randrange(3, 400) for _ in range(rng.randrange(12))]
        assert c.decode(ids) == sp.decode(ids), ids


def test_long_text_in_blocks(both, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_CHARS", 50)
    same(both, "some words  and  spaces\nin   many blocks " * 60)


def test_query_against_library(spark, both):
    sp = both[1]
    got = {r.doc_id: r for r in C.q_sentencepiece(spark, "/root/testdata/sf0.01").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = sp.encode(r.text) + [2]
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())


def test_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, [1], "x"), (None, "a", None, None)], "doc_id long, text string, ids array<int>, n_tokens string")
    got = {r.doc_id: (r.ids, r.decoded) for r in C.encode_documents(df, PATH).collect()}
    assert got[1] == ([2], "") and got[None][1] == "a"
    assert C.digest_documents(df.limit(0), PATH).count() == 0
