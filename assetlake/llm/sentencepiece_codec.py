"""Exact SentencePiece BPE encoding and decoding (merge-type models with byte fallback).

Encoding is by backtracking instead of a merge queue: an Aho-Corasick automaton
over the vocabulary gives the pieces that start at each position, the longest is
tried first, a piece may follow its left neighbour only if re-merging the two
gives them back, and a bitfield keeps the positions found to be no boundary.
Only the vocabulary is read with the sentencepiece library.

Texts are cut where no piece spans the cut, so a word is encoded once per worker
and found in a bounded cache afterwards. Whole texts are processed, in blocks;
memory is bounded by a batch of rows and the cache.

Defined results: NULL and empty text give the end id alone and decode to "";
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from assetlake.llm.common import bounded_batches, table, unclash

SPACE = "▁"
BLOCK_CHARS = 1 << 20
CACHE_WORDS = 400_000
CACHE_LONGEST = 64

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class _Words(dict):
    """Word -> ids; two generations bound the memory, hits stay plain dict lookups."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, word):
        ids = self.old.get(word) or self.encode(word)
        if len(word) <= CACHE_LONGEST:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Codec:
    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = sp.get_piece_size()
        special = [i for i in range(n) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)]
        pieces = {sp.id_to_piece(i): i for i in range(n)}
        for i in special:
            pieces.pop(sp.id_to_piece(i))
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces with an inner space are not supported")
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in special if sp.is_byte(i)}
        self.eos = sp.eos_id()
        self.ids = pieces
        self.score = {p: sp.get_score(i) for p, i in pieces.items()}
        #: neighbouring characters that stand together in some piece; between any others a text can be cut
        self.joins = {p[k:k + 2] for p in pieces for k in range(len(p) - 1)}
        self.pairs: dict[tuple[str, str], bool] = {}
        trie = ahocorasick.Automaton()
        for p in pieces:
            if len(p) == 1 or self.merge(p) == [p]:  # a piece that merging can't reach never occurs
                trie.add_word(p, p)
        trie.make_automaton()
        self.trie = trie
        self.words = _Words(self._word)
        newline = "" if any("\n" in p for p in pieces) else "\n"
        self.chunk = re.compile(f"{SPACE}+[^{SPACE}{newline}]*|[^{SPACE}{newline}]+" + (f"|{newline}" if newline else ""))
        # for decoding, byte pieces become lone surrogates first, which no text holds
        self.text = [sp.id_to_piece(i) for i in range(n)]
        for i in special:
            self.text[i] = ""
        for b, i in self.bytes.items():
            self.text[i] = chr(0xDC00 + b)
        self.byte_runs = re.compile("[\udc00-\udcff]+")

    def merge(self, s: str) -> list[str]:
        """Plain BPE: merge the best scored pair, leftmost first, until none is left."""
        parts, score = list(s), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                x = score.get(parts[k] + parts[k + 1])
                if x is not None and (best is None or x > best):
                    best, at = x, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether re-merging two adjacent pieces gives them back."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) > CACHE_WORDS:
                self.pairs.clear()
            found = self.pairs[left, right] = left[-1] + right[0] not in self.joins or self.merge(left + right) == [left, right]
        return found

    def _segment(self, s: str) -> list[str]:
        """Pieces of a string of known characters, by backtracking."""
        n = len(s)
        starts: list[list[str]] = [[] for _ in range(n)]  # pieces by start, shorter first
        for end, p in self.trie.iter(s):
            starts[end - len(p) + 1].append(p)
        failed = bytearray((n >> 3) + 1)
        out: list[str] = []
        at, k = 0, len(starts[0]) - 1
        choice: list[int] = []
        while at < n:
            here = starts[at]
            while k >= 0:
                p = here[k]
                end = at + len(p)
                if not failed[end >> 3] & (1 << (end & 7)) and (not out or self.fits(out[-1], p)):
                    out.append(p)
                    choice.append(k)
                    at, k = end, len(starts[end]) - 1 if end < n else 0
                    break
                k -= 1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                if not out:
                    return self.merge(s)
                at -= len(out.pop())
                k = choice.pop() - 1
        return out

    def _word(self, word: str) -> tuple[int, ...]:
        ids: list[int] = []
        known, joins, start = self.ids, self.joins, 0
        n = len(word)
        for k in range(1, n + 1):
            if k < n and word[k - 1:k + 1] in joins:
                continue
            s, start = word[start:k], k
            if s in known and (len(s) == 1 or s in self.trie):
                ids.append(known[s])
            elif len(s) == 1:
                ids.extend(self.bytes[b] for b in s.encode())
            else:
                ids.extend(known[p] for p in self._segment(s))
        return tuple(ids)

    def blocks(self, text: str):
        """Ids of a text without the end id, a block of about BLOCK_CHARS at a time."""
        if not text:
            return
        text = SPACE + text.replace(" ", SPACE)
        at, word = 0, self.words.__getitem__
        while at < len(text):
            to = at + BLOCK_CHARS
            while to < len(text) and not (text[to] == SPACE and text[to - 1] != SPACE):
                to += 1
            yield list(chain.from_iterable(map(word, self.chunk.findall(text, at, to))))
            at = to

    def encode(self, text: str) -> list[int]:
        return [*chain.from_iterable(self.blocks(text)), self.eos]

    def decode(self, ids: list[int]) -> str:
        """As the library's decode(ids): control ids vanish, byte ids are joined to UTF-8, invalid bytes
        become U+FFFD each, and the leading space that encoding added goes."""
        out = "".join(map(self.text.__getitem__, ids))
        out = out[1:] if out[:1] == SPACE else out
        out = out.replace(SPACE, " ")
        return self.byte_runs.sub(lambda m: bytes(ord(c) - 0xDC00 for c in m[0]).decode("utf-8", "each_byte"), out)


@lru_cache(maxsize=2)
def codec(model_path: str) -> Codec:
    """One codec per worker and model."""
    return Codec(model_path)


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (array of int, end id last) and the text decoded from them."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches):
        c = codec(model_path)
        for b in batches:
            ids = [c.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, schema.field(1).type),
                                              pa.array([c.decode(x) for x in ids], pa.string())], schema=schema)

    return unclash(docs, ["doc_id", "text"]).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digests of ``encode_documents`` without moving the ids."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())])

    def run(batches):
        c = codec(model_path)
        decimal = [str(i) for i in range(len(c.text))]
        for b in batches:
            ns, hashes, texts = [], [], []
            for t in b.column(1).to_pylist():
                ids = c.encode(t or "")
                ns.append(len(ids))
                hashes.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                texts.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ns, pa.int64()), pa.array(hashes, pa.string()),
                                              pa.array(texts, pa.string())], schema=schema)

    return unclash(docs, ["doc_id", "text"]).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def q_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
