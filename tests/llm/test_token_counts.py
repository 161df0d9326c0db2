import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from assetlake.llm import sentencepiece_codec as S
from assetlake.llm import token_counts as C

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, steps string, n_tokens array<int>"


@pytest.fixture(scope="module")
def both():
    return C.counter(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def same_at_every_prefix(both, text):
    c, sp = both
    assert C.counts(c.steps(text)).tolist() == [len(sp.encode(text[:k])) for k in range(len(text) + 1)]


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "\n", "a\nb\t", "é　x ﬁ", "▁a▁▁b", "a\x00b", "<s>a</s><0x41>", "x" * 300, "ab" * 200,
                                  " " * 100, "日本語テキスト🙂🙂", "aaaaaaaaaaaab" * 9, "!!!???...,,,", "http://a.b/c?d=e&f=%20", "1234567890" * 9,
                                  "🙂", "🙂 internationalisation of unbelievable counterrevolutionaries"])
def test_cases_at_every_prefix(both, text):
    same_at_every_prefix(both, text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text_at_every_prefix(both, text):
    same_at_every_prefix(both, text.encode("utf-8", "ignore").decode())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aeionrstlhd .,\n▁'=-", max_size=60))
def test_word_like_text_at_every_prefix(both, text):
    same_at_every_prefix(both, text)


def test_long_text_in_blocks(both, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_CHARS", 50)
    same_at_every_prefix(both, "some words  and  spaces\nin   many blocks " * 12)


def test_query_against_library(spark, both):
    sp = both[1]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in C.q_token_counts(spark, "/root/testdata/sf0.01").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows) and any(x[2] for x in got.values())
    for r in rows:
        n = len(sp.encode(r.text))
        assert got[r.doc_id] == (len(r.text.encode()), n, n > 4096)


def test_budget_questions_without_encoding_again(spark, both, monkeypatch):
    sp, rng = both[1], random.Random(3)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(40).collect()
    texts = {r.doc_id: r.text[:400] for r in rows} | {-1: "", -2: "🙂é" * 30}
    asked = {k: [0, 1, len(t), len(t) + 5, -3, None, rng.randrange(len(t) + 1)] for k, t in texts.items()}
    df = spark.createDataFrame([(k, t, asked[k]) for k, t in texts.items()], "doc_id long, text string, ask array<int>")
    prefixes = C.prefix_table(df, PATH).join(df.select("doc_id", "ask"), "doc_id")
    for r in C.cut_to(C.counts_at(prefixes, "ask"), 20).collect():
        t = texts[r.doc_id]
        assert r.tokens_at == [None if k is None else len(sp.encode(t[:max(k, 0)])) for k in asked[r.doc_id]]
        every = [len(sp.encode(t[:k])) for k in range(len(t) + 1)]
        best = max(k for k, n in enumerate(every) if n <= 20)
        assert (r.fit_chars, r.fit_tokens) == (best, every[best])
    with pytest.raises(ValueError):
        C.cut_to(prefixes, -1)


def test_nulls_repeats_clashing_columns_and_empty(spark, both):
    rows = [(1, None, "x", [1]), (None, "a b", None, None), (2, "", None, None), (3, "z " * 400_000, None, None), (4, "same", None, None), (4, "same", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(C.cut_to(C.over(C.prefix_table(df, PATH), 5), 5).drop("steps").collect(), key=lambda r: r.doc_id or 0)
    assert [(r.doc_id, r.n_bytes, r.over_limit) for r in got] == [(None, 3, False), (1, 0, False), (2, 0, False), (3, 800_000, True), (4, 4, False), (4, 4, False)]
    assert got[3].n_tokens == len(both[1].encode(rows[3][1])) and (got[1].n_tokens, got[1].fit_chars) == (0, 0)
    assert C.prefix_table(df.limit(0), PATH).count() == 0


def test_piece_characters_must_be_pieces():
    class Odd:
        ids = {"ab": 0, "a": 1}
    with pytest.raises(ValueError):
        C.PrefixCounter(Odd())
    assert S.codec(PATH).eos == 2
