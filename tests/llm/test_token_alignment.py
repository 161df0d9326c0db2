import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from assetlake.llm import token_alignment as A

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, block string, pair array<int>, n_a string"


@pytest.fixture(scope="module")
def tokens():
    """Tokens (id, bytes) of a text by both, from the libraries' own offsets and pieces."""
    a, sp = tokenizers.Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    dec = {}
    for k, c in enumerate(map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)])):
        dec[c] = ord(c)
    for k, b in enumerate([x for x in range(256) if chr(x) not in dec]):
        dec[chr(256 + k)] = b

    def both(text):
        if not text:
            return [], []
        e = a.encode(" " + text, add_special_tokens=False)
        x = [(i, bytes(dec[c] for c in t)) for i, t in zip(e.ids, e.tokens, strict=True)]
        y = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(text)]
        want = (" " + text).encode()
        return (x, y) if b"".join(b for _, b in x) == want == b"".join(b for _, b in y) else ([], [])
    return both


def links_and_groups(x, y):
    def spans(ts):
        at = 0
        for i, b in ts:
            yield at, at + len(b), i
            at += len(b)
    sx, sy = list(spans(x)), list(spans(y))
    links = [(i, j) for s, e, i in sx for u, v, j in sy if s < v and u < e] if len(sx) < 400 else None
    if links is None:
        links, j0 = [], 0
        for s, e, i in sx:
            while sy[j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(sy) and sy[j][0] < e:
                links.append((i, sy[j][2]))
                j += 1
    ends = sorted({e for _, e, _ in sx} & {e for _, e, _ in sy})
    groups, last = [], 0
    for end in ends:
        groups.append(",".join(str(i) for s, e, i in sx if last < e <= end) + "|" + ",".join(str(i) for s, e, i in sy if last < e <= end)
                      if len(sx) < 400 else None)
        last = end
    return links, groups


def expected(tokens, rows):
    found, docs, per_a = [], Counter(), defaultdict(dict)
    for _, text in rows:
        x, y = tokens(text)
        links, groups = links_and_groups(x, y)
        found.append((x, y, links, groups))
        docs.update(set(links))
    for (i, j), n in docs.items():
        per_a[i][j] = n
    out = []
    for (doc_id, _), (x, y, links, groups) in zip(rows, found, strict=True):
        sha = "" if not x else hashlib.sha256(";".join(groups).encode()).hexdigest() if None not in groups else None
        out.append((doc_id, len(x), len(y), len(groups), len(links), sum(docs[p] == max(per_a[p[0]].values()) for p in links),
                    sum(docs[p] for p in links), sha))
    return out, docs


def check(spark, tokens, rows, schema="doc_id long, text string", extra=()):
    found = A.align(spark.createDataFrame([(*r, *extra) for r in rows], schema), A_PATH, B_PATH)
    want, docs = expected(tokens, rows)
    got = [tuple(r) for r in A.documents(found).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]
    key = lambda r: tuple((x is None, x) for x in r[:7])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:7] == w[:7] and w[7] in (None, g[7])
    assert {(r.a_id, r.b_id): r.n_docs for r in A.pair_counts(found, A_PATH, B_PATH).collect()} == docs
    return found


HARD = ["", None, " ", "a", "▁a", "a ▁", "<|endoftext|> and <s>", "日本語テキスト🙂🙂 x", "é \x00 ﬁ", "ababababa", "\n\n  x\t\ty", "1234567890",
        "unbelievable counterrevolutionaries' internationalisation"]


def test_hard_texts(spark, tokens):
    found = check(spark, tokens, [(k, t) for k, t in enumerate(HARD)] + [(3, "a"), (3, "a"), (None, "a b")])
    assert found.blocks.count() >= 1


def test_documents_against_brute_force(spark, tokens, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_CHARS", 20_000)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(spark, tokens, rows)


def test_query(spark, tokens):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want, _ = expected(tokens, rows)
    got = {r.doc_id: r for r in A.q_token_alignment(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    for w in want:
        r = got[w[0]]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == w[1:7] and w[7] in (None, r.groups_sha256)


def test_groups_as_written(spark, tokens):
    rows = [(k, t) for k, t in enumerate(HARD)]
    got = {r.doc_id: r.groups for r in A.groups(spark.createDataFrame(rows, "doc_id long, text string"), A_PATH, B_PATH).collect()}
    assert got == {k: ";".join(links_and_groups(*tokens(t))[1]) for k, t in rows}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=4))
def test_any_texts(tokens, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = A.aligner(A_PATH, B_PATH).align(texts)
    at_same = at_odd = 0
    for k, t in enumerate(texts):
        links, groups = links_and_groups(*tokens(t))
        assert (got["n_groups"][k], got["n_links"][k], got["groups"][k].decode()) == (len(groups), len(links), ";".join(groups))
        mine = Counter()
        for i in range(at_same, at_same := at_same + got["same_n"][k]):
            a = int(got["same_id"][i])
            mine[a, int(A.aligner(A_PATH, B_PATH).same[a])] += int(got["same_links"][i])
        for i in range(at_odd, at_odd := at_odd + got["odd_n"][k]):
            mine[divmod(int(got["pair"][got["odd_code"][i]]), A.aligner(A_PATH, B_PATH).n_b)] += int(got["odd_links"][i])
        assert mine == Counter(links)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aeinst'.,\n\t 1▁é\x1c\x85\u2028", max_size=40))
def test_word_by_word_is_whole(text):
    both = A.aligner(A_PATH, B_PATH)
    a, b = both.encode([text])
    whole = next(iter(both._whole([text]))) if text else (b"", b"")
    assert (a[0], b[0]) == tuple(x or b"" for x in whole)


def test_clashing_columns_long_text_and_empty(spark, tokens):
    rows = [(1, "some words and more " * 60_000), (2, None), (2, ""), (4, "some words"), (4, "some words")]
    check(spark, tokens, rows, SCHEMA, ("x", [1], "y"))
    check(spark, tokens, [(1, None), (2, "")])
    none = A.align(spark.createDataFrame([], SCHEMA), A_PATH, B_PATH)
    assert A.documents(none).count() == 0 and A.pair_counts(none, A_PATH, B_PATH).count() == 0
