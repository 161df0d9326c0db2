"""Order-preserving sequence packing by dynamic programming.

Each scan partition tokenizes its documents in order (an end id behind each) and
cuts the stream into sequences of at most ``size`` tokens. Cuts lie at document
ends, sentence ends (``SENTENCE``), or, in long stretches without either, inside
(``INSIDE``); the cuts minimise padding plus these penalties over a block of
tokens. A cut at j costs min over i of f[i] + size - (j - i): f[i] + i is kept in
a monotone queue, so a transition is constant time. A sequence whose length is a
power of two needs no padding; such lengths are extra transitions. No row is
shuffled; a task holds one block of tokens, and what follows the last but one cut
of a block is solved again with the next block.

Defined results: NULL and empty texts are the end id alone; rows that repeat are
packed each; a document longer than a sequence spans several. An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from assetlake.llm.common import bounded_batches, table, unclash

SIZE = 4096
SENTENCE = 8.0  # a cut within a document at a sentence end costs as much as 8 padding tokens
INSIDE = 32.0
STRETCH = 256
BLOCK_TOKENS = 1 << 18
BLOCK_CHARS = 1 << 20
OUT_ROWS = 2048  # pieces of a batch that a task hands on; with their ids, a batch ends at BLOCK_TOKENS of them too
CACHE_WORDS = 800_000
END_ID = 2
END = np.uint32(END_ID).tobytes()
SMALLEST_POWER = 64
#: lower-casing first is safe only where composing and lower-casing commute, and special tokens are told by case
UNSAFE = re.compile("[^\x00-ɏ]|İ|<\\|")
IDS = array("I" if array("I").itemsize == 4 else "L").typecode  # unsigned 32-bit
WORD_AND_MARKS = re.compile(r"([^\W\d_]+)([.,!?:;()#$%&*+/=@\"-]+)")


class Tokenizer:
    """Ids exactly as tokenizers' encode(text, add_special_tokens=False): its pieces never span white space, so
    chunks between blanks are encoded once and found in a bounded cache, as the bytes of their 32-bit ids: a text's ids
    are those bytes joined."""

    def __init__(self, path: str):
        import tokenizers

        self.tok = tokenizers.Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {"": b""}
        vocab = self.tok.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)  # pieces that end a word
        for piece, i in vocab.items():
            self.closes[i] = piece.endswith("</w>")
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for piece, i in vocab.items():
            p = piece.removesuffix("</w>")
            self.ends[i] = piece != p and p.endswith((".", "!", "?")) and not any(c.isalnum() for c in p)

    def _learn(self, missing: set[str]) -> None:
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
            cache[""] = b""
        plain, marked, other = [], [], []
        for c in missing:
            if c.isalpha():
                plain.append(c)
            elif (m := WORD_AND_MARKS.fullmatch(c)) and m[1].isalpha():
                marked.append((c, *m.groups()))
            else:
                other.append(c)
        known = {w for _, w, _ in marked} | {m for _, _, m in marked}
        for c in known:
            if c not in cache:
                (plain if c.isalpha() else other).append(c)
        plain = list(dict.fromkeys(plain))
        if plain:  # a word of letters is one piece before merging and its last id closes it, so one call does for many
            ids = np.array(self.tok.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, np.uint32)
            data, ends = ids.tobytes(), 4 * (np.flatnonzero(self.closes[ids]) + 1)
            if len(ends) == len(plain) and ends[-1] == len(data):
                found = map(data.__getitem__, map(slice, [0, *ends[:-1].tolist()], ends.tolist()))
                cache.update(zip(plain, found, strict=True))
            else:
                other += plain
        for c, enc in zip(other, self.tok.encode_batch_fast(other, add_special_tokens=False), strict=True):
            cache[c] = array(IDS, enc.ids).tobytes()
        for c, w, m in marked:
            cache[c] = cache[w] + cache[m]

    def _found(self, texts: list[str]) -> list[list[bytes]]:
        """The ids of each text's chunks; a chunk is looked up once, those not yet known are learned together."""
        get, rows, open_ = self.cache.get, [], []
        for text in texts:
            chunks = self._chunks(text)
            rows.append(row := list(map(get, chunks)))
            if None in row:
                open_.append((row, [(k, c) for k, (c, f) in enumerate(zip(chunks, row, strict=True)) if f is None]))
        if open_:
            self._learn({c for _, missing in open_ for _, c in missing})
            for row, missing in open_:
                for k, c in missing:
                    row[k] = self.cache[c]
        return rows

    @staticmethod
    def _chunks(text: str) -> list[str]:
        unsafe = "<|" in text if text.isascii() else UNSAFE.search(text)
        return (text if unsafe else text.lower()).replace("\n", " ").split(" ")

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text with the end id, a block of about BLOCK_CHARS at a time."""
        parts, at = [], 0
        while at < len(text):
            to = len(text) if at + BLOCK_CHARS >= len(text) else text.find(" ", at + BLOCK_CHARS)
            to = len(text) if to < 0 else to
            parts += self._found([text[at:to]])[0]
            at = to + 1
        return np.frombuffer(b"".join([*parts, END]), np.uint32)

    def encode_many(self, texts: list[str]):
        """``encode`` of each text; the unknown words of up to BLOCK_CHARS of texts are learned together."""
        at = 0
        while at < len(texts):
            size, to = len(texts[at]), at + 1
            while to < len(texts) and size + len(texts[to]) <= BLOCK_CHARS:
                size += len(texts[to])
                to += 1
            if size > BLOCK_CHARS:
                yield self.encode(texts[at])
            else:
                for row in self._found(texts[at:to]):
                    row.append(END)
                    yield np.frombuffer(b"".join(row), np.uint32)
            at = to


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def choose_cuts(pos: list[int], penalty: list[float], size: int = SIZE) -> list[int]:
    """Cuts from pos[0] = 0 to pos[-1] at least cost; neighbours in ``pos`` are at most ``size`` apart.

    Cost of a sequence: size - length (0 for a power of two from SMALLEST_POWER), plus the penalty of its end.
    """
    n = len(pos)
    cost, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # (f + pos, pos, index), growing
    index = {0: 0}
    powers = [1 << k for k in range(SMALLEST_POWER.bit_length() - 1, 40) if 1 << k < size]
    for j in range(1, n):
        p = pos[j]
        while queue[0][1] < p - size:
            queue.popleft()
        key, _, i = queue[0]
        best = key + size - p
        for w in powers:
            k = index.get(p - w)
            if k is not None and cost[k] < best:
                best, i = cost[k], k
        best += penalty[j]
        cost[j], back[j] = best, i
        index[p] = j
        key = best + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, p, j))
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = back[j]
    return [pos[k] for k in reversed(cuts)]


def cut_points(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, size: int) -> tuple[list[int], list[float]]:
    """Positions where a sequence may end, with their penalties, for a stream of ids."""
    n = len(ids)
    sentence = np.flatnonzero(ends[ids]) + 1
    pos = np.union1d(np.concatenate(([0], sentence, doc_ends)), [n])
    stretch = min(STRETCH, size)
    gaps = np.flatnonzero(np.diff(pos) > stretch)
    inside = [np.arange(pos[g] + stretch, pos[g + 1], stretch) for g in gaps]
    every = np.union1d(pos, np.concatenate(inside)) if inside else pos
    penalty = np.full(len(every), INSIDE)
    penalty[np.isin(every, sentence)] = SENTENCE
    penalty[np.isin(every, doc_ends)] = 0.0
    return every.astype(int).tolist(), penalty.tolist()


def pack_stream(docs, ends: np.ndarray, size: int = SIZE, block: int = BLOCK_TOKENS):
    """Pieces (doc_id, start, ids, doc_tokens, sequence, offset) of an iterable of (doc_id, ids)."""
    held: list[tuple] = []  # (doc_id, ids of the part not yet packed, its start, doc_tokens)
    tokens, sequence = 0, 0

    def emit(n):
        """The next n tokens are one sequence."""
        nonlocal sequence, tokens
        offset = 0
        while offset < n:
            doc_id, ids, start, total = held[0]
            take = min(len(ids), n - offset)
            yield doc_id, start, ids[:take], total, sequence, offset
            offset += take
            if take == len(ids):
                held.pop(0)
            else:
                held[0] = (doc_id, ids[take:], start + take, total)
        sequence += 1
        tokens -= n

    def solve(last):
        ids = np.concatenate([h[1] for h in held])
        doc_ends = np.cumsum([len(h[1]) for h in held])
        if held and len(held[-1][1]) + held[-1][2] < held[-1][3]:
            doc_ends = doc_ends[:-1]
        cuts = [0, *choose_cuts(*cut_points(ids, doc_ends, ends, size), size)]
        lengths = np.diff(cuts).tolist()
        if not last:
            lengths = lengths[:-2]
        elif lengths:
            n = lengths[-1]
            parts = [1 << k for k in reversed(range(n.bit_length())) if n >> k & 1]
            if n & (n - 1) and size - n > INSIDE * (len(parts) - 1):  # the very last one: powers of two need no padding
                lengths[-1:] = parts
        for n in lengths:
            yield from emit(n)

    for doc_id, ids in docs:
        for at in range(0, len(ids), block):
            part = ids[at:at + block]
            held.append((doc_id, part, at, len(ids)))
            tokens += len(part)
            if tokens >= max(block, 8 * size):
                yield from solve(False)
    if held:
        yield from solve(True)


def batched(pieces, with_ids: bool):
    """Lists of pieces, each of at most OUT_ROWS, and with their ids of about BLOCK_TOKENS: 2 MB of ids, whatever a piece holds."""
    rows, held = [], 0
    for piece in pieces:
        rows.append(piece)
        held += len(piece[2]) if with_ids else 0
        if len(rows) >= OUT_ROWS or held >= BLOCK_TOKENS:
            yield rows
            rows, held = [], 0
    if rows:
        yield rows


def pack(docs: DataFrame, tokenizer_path: str, size: int = SIZE, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]."""
    from pyspark import TaskContext

    bounded_batches(docs.sparkSession)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([(c, pa.int64()) for c in names] + [("ids", pa.list_(pa.uint32()))] * with_ids)

    def run(batches):
        tok = tokenizer(tokenizer_path)
        first = TaskContext.get().partitionId() << 33
        stream = (x for b in batches for x in zip(b.column(0).to_pylist(), tok.encode_many([t or "" for t in b.column(1).to_pylist()]), strict=True))
        for pieces in batched(pack_stream(stream, tok.ends, size), with_ids):
            rows = [(doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, first + seq, offset, *[ids] * with_ids)
                    for doc_id, start, ids, total, seq, offset in pieces]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    ddl = ", ".join(f"{c} long" for c in names) + (", ids array<long>" if with_ids else "")
    if with_ids:
        schema = schema.set(7, pa.field("ids", pa.list_(pa.int64())))
    return unclash(docs, ["doc_id", "text"]).mapInArrow(run, ddl)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the training sequences, as pieces with their ids."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
