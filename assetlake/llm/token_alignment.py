"""Cross-tokenizer alignment: a byte-level BPE (A) against a SentencePiece model (B).

Both encode a text to tokens over the same bytes (a space and the text). Offsets where a token of A and one of
B end cut the tokens into groups; an A and a B token are linked where their bytes overlap. An identity map gives
for each A id the B id of the same bytes; links along it, all one-to-one groups among them, are counted in a
vector as long as A's vocabulary. Only the other links enter a shuffle of id pairs, and of those just the
distinct pairs of a block of texts with the number of its documents that hold them.

``align`` encodes once and stores a row per block (``BLOCK_CHARS`` of texts): the documents' figures, their
links by id, and the block's distinct pairs. ``pair_counts`` sums over the blocks, ``documents`` brings the counts
back to the blocks and scores every document. What the driver holds is bounded by A's vocabulary; a pair meets
at most one row a block, so no id pair is a hot key.

Defined results: texts that are NULL or empty, or whose tokens don't give back the bytes (as with U+2581, a space
to B), have no tokens: zeros and an empty ``groups``. Special tokens' strings inside texts are plain text.
Rows that repeat, also under one doc_id, are a document each and count as such; extra columns are ignored; an
empty table gives an empty result. A text is encoded whole, so memory grows with the longest text.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from dataclasses import dataclass
from functools import lru_cache
from itertools import batched, chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.common import bounded_batches, discard, store, table, unclash

BLOCK_CHARS = 1 << 21
BLOCK_DOCS = 4096
CACHE_WORDS = 300_000
#: texts that aren't encoded word by word: white space before a space, a space at the end, words too long to keep
WHOLE = re.compile(r"\s |[^ ]{65}| \Z")


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


def cut(found: bytes, starts: list[int]) -> list[bytes]:
    return [found[s:e] for s, e in pairwise([*starts, len(found)])]


class Aligner:
    """Both tokenizers, the bytes of their tokens and the identity map."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters, vocab = byte_alphabet(), self.a.get_vocab()
        self.n_a, self.n_b = max(vocab.values()) + 1, self.b.get_piece_size()
        self.a_bytes = [b""] * self.n_a
        for piece, i in vocab.items():
            self.a_bytes[i] = bytes(letters[c] for c in piece)
        b_bytes, ident = [], {}
        for i in range(self.n_b):
            piece = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
            if not (self.b.is_control(i) or self.b.is_unknown(i)) and (b_bytes[i] not in ident or self.b.is_byte(ident[b_bytes[i]])):
                ident[b_bytes[i]] = i
        self.b_bytes = b_bytes
        self.same = np.array([ident.get(x, -1) for x in self.a_bytes], np.int64)
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in b_bytes], np.int64)
        ends = lambda n, inner, last: [b"%d%b" % (i, inner) for i in range(n)] + [b"%d%b" % (i, last) for i in range(n)]
        self.written = ends(self.n_a, b",", b"|") + ends(self.n_b, b",", b";")

        #: ids of words behind a space, as 32-bit integers; None where the tokens don't give back the bytes
        self.words_a: dict[str, bytes | None] = {}
        self.words_b: dict[str, bytes | None] = {}
        inner = lambda found: any(" " in x.lstrip(" ") for x in found)
        tried = self.a.pre_tokenizer.pre_tokenize_str(" ".join(map(chr, [*range(33, 1024), 0x3042, 0x6F22, 0x1F642])))
        self.a_first, self.b_first = (np.array([x[:1] == b" " for x in found]) for found in (self.a_bytes, b_bytes))
        self.by_word = not inner(bytes(letters[c] for c in x).decode("latin-1") for x, _ in tried) and not inner(x.decode("latin-1") for x in b_bytes)

    def _whole(self, texts: list[str]):
        """Ids of both for each whole text, as 32-bit integers, or None twice."""
        found_a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        for t, a, b in zip(texts, found_a, self.b.encode(texts, num_threads=1), strict=True):
            want, a = b" " + t.encode(), a.ids
            fits = b"".join(map(self.a_bytes.__getitem__, a)) == want == b"".join(map(self.b_bytes.__getitem__, b))
            yield (array("i", a).tobytes(), array("i", b).tobytes()) if fits else (None, None)

    def _together(self, words: list[str]):
        """Ids of many words from one text that joins them: a word's first token alone begins with a space."""
        joined = " ".join(words)
        a, b = (np.frombuffer(x or b"", np.int32) for x in next(self._whole([joined])))
        first_a, first_b = (np.flatnonzero(first[ids]) for first, ids in ((self.a_first, a), (self.b_first, b)))
        if len(first_a) != len(words) or len(first_b) != len(words):
            return self._whole(words)
        return zip(*(cut(ids.tobytes(), (first * 4).tolist()) for ids, first in ((a, first_a), (b, first_b))), strict=True)

    def _learn(self, words: set[str]) -> None:
        new = words.difference(self.words_a)
        if len(self.words_a) + len(new) > CACHE_WORDS:  # what is at hand stays
            held = words.difference(new)
            self.words_a, self.words_b = ({w: known[w] for w in held} for known in (self.words_a, self.words_b))
        for some in batched(new, 10_000):
            for w, (a, b) in zip(some, self._together(list(some)), strict=True):
                self.words_a[w], self.words_b[w] = a, b

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Ids of both for each text, as 32-bit integers; none where the text has no tokens.

        No token of either crosses from another character to a space, and nothing before a single space bears on what
        follows: such texts are encoded word by word, each word once. All others are encoded whole.
        """
        ids_a, ids_b, split, whole = [b""] * len(texts), [b""] * len(texts), [], []
        for k, t in enumerate(texts):
            if t:
                if self.by_word and not WHOLE.search(" " + t):
                    split.append((k, t.split(" ")))
                else:
                    whole.append(k)
        for k, (a, b) in zip(whole, self._whole([texts[k] for k in whole]), strict=True):
            ids_a[k], ids_b[k] = a or b"", b or b""
        self._learn(set(chain.from_iterable(words for _, words in split)))
        for k, words in split:
            a = list(map(self.words_a.__getitem__, words))
            if None not in a:
                ids_a[k], ids_b[k] = b"".join(a), b"".join(map(self.words_b.__getitem__, words))
        return ids_a, ids_b

    def align(self, texts: list[str | None]) -> dict:
        """Figures of each text, its groups as written, and its links by id pair (see ``align`` below)."""
        ids_a, ids_b = self.encode(texts)
        n_a, n_b = (np.array([len(x) >> 2 for x in ids], np.int64) for ids in (ids_a, ids_b))
        a, b = (np.frombuffer(b"".join(ids), np.int32).astype(np.int64) for ids in (ids_a, ids_b))
        del ids_a, ids_b
        end_a, end_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        doc_end = np.concatenate(([0], end_a))[np.cumsum(n_a)]  # all texts stand one behind the other
        both = np.concatenate((end_a, end_b))
        both.sort(kind="stable")
        twice = both[1:] == both[:-1]
        common = both[1:][twice]  # ends of groups
        points = both[np.concatenate(([True], ~twice))] if len(both) else both  # every stretch between two ends is one link
        per_doc = lambda ends: np.diff(np.searchsorted(ends, doc_end, "right"), prepend=0)
        n_groups, n_links = per_doc(common), per_doc(points)

        link_a, link_b = a[np.searchsorted(end_a, points)], b[np.searchsorted(end_b, points)]
        link_doc = np.repeat(np.arange(len(texts)), n_links)
        regular = self.same[link_a] == link_b
        same, same_links = np.unique(link_doc[regular] * self.n_a + link_a[regular], return_counts=True)
        odd = ~regular
        n_pairs = self.n_a * self.n_b
        pairs, odd_links = np.unique(link_doc[odd] * n_pairs + link_a[odd] * self.n_b + link_b[odd], return_counts=True)
        distinct, code, docs_of = np.unique(pairs % n_pairs, return_inverse=True, return_counts=True)
        each = lambda keys, width: np.bincount(keys // width, minlength=len(texts))
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
                "groups": self._written(a, b, end_a, end_b, common, n_a + n_b),
                "same_n": each(same, self.n_a), "same_id": same % self.n_a, "same_links": same_links,
                "odd_n": each(pairs, n_pairs), "odd_code": code, "odd_links": odd_links, "pair": distinct, "pair_docs": docs_of}

    def _written(self, a, b, end_a, end_b, common, sizes) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of each text: decimal ids, groups in order."""
        upto_a, upto_b = np.searchsorted(end_a, common, "right"), np.searchsorted(end_b, common, "right")
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        at_a, at_b = np.arange(len(a)), np.arange(len(b))
        codes = np.empty(len(a) + len(b), np.int64)
        codes[at_a + np.concatenate(([0], upto_b))[group_a]] = a + self.n_a * (at_a + 1 == upto_a[group_a])
        codes[at_b + upto_a[group_b]] = 2 * self.n_a + b + self.n_b * (at_b + 1 == upto_b[group_b])
        written, at, out = list(map(self.written.__getitem__, codes.tolist())), 0, []
        for n in sizes.tolist():
            out.append(b"".join(written[at:at + n])[:-1])
            at += n
        return out


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner per worker and pair of files."""
    return Aligner(a_path, b_path)


def _blocks_of(batches):
    """Lists of ids and texts of at most BLOCK_CHARS and BLOCK_DOCS, or one longer text."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n = len(t or "")
            if texts and (size + n > BLOCK_CHARS or len(texts) >= BLOCK_DOCS):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += n
    if texts:
        yield ids, texts


FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
PACKED = [*FIGURES, "same_n", "same_id", "same_links", "odd_n", "odd_code", "odd_links"]  # 32-bit integers


@dataclass
class Alignment:
    blocks: DataFrame
    n_a: int
    n_b: int


def align(docs: DataFrame, a_path: str, b_path: str) -> Alignment:
    """Encode and align every text of ``docs`` (doc_id, text) once; stored, a row per block of texts."""
    bounded_batches(docs.sparkSession)
    types = {"block": pa.int64(), "doc_id": pa.list_(pa.int64()), "groups_sha256": pa.list_(pa.string())} | dict.fromkeys(PACKED, pa.binary()) | {
        "pair": pa.list_(pa.int64()), "pair_docs": pa.list_(pa.int64())}
    schema = pa.schema(list(types.items()))

    def run(batches):
        from pyspark import TaskContext

        both, first = aligner(a_path, b_path), TaskContext.get().partitionId() << 33
        for k, (ids, texts) in enumerate(_blocks_of(batches)):
            found = both.align(texts)
            row = {"block": first + k, "doc_id": ids, "pair": found["pair"], "pair_docs": found["pair_docs"],
                   "groups_sha256": [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(found["groups"], found["n_a"], strict=True)]}
            row |= {c: found[c].astype("<i4").tobytes() for c in PACKED}
            yield pa.RecordBatch.from_arrays([pa.array([row[c]], t) for c, t in types.items()], schema=schema)

    ddl = ", ".join(["block long, doc_id array<long>, groups_sha256 array<string>", *(f"{c} binary" for c in PACKED),
                     "pair array<long>, pair_docs array<long>"])
    blocks = store(unclash(docs, ["doc_id", "text"]).mapInArrow(run, ddl), "alignment-blocks")
    both = aligner(a_path, b_path)
    return Alignment(blocks, both.n_a, both.n_b)


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id and the groups of its text as written (`a1,a2|b1;a3|b2,b3`)."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("groups", pa.string())])

    def run(batches):
        both = aligner(a_path, b_path)
        for ids, texts in _blocks_of(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([g.decode() for g in both.align(texts)["groups"]], pa.string())],
                                             schema=schema)

    return unclash(docs, ["doc_id", "text"]).mapInArrow(run, "doc_id long, groups string")


def _same_counts(found: Alignment) -> DataFrame:
    """a_id, n_docs of links along the identity map: each task adds its blocks up in one vector of A's vocabulary."""
    size, schema = found.n_a, pa.schema([("a_id", pa.int64()), ("n_docs", pa.int64())])

    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            for ids in b.column(0).to_pylist():
                total += np.bincount(np.frombuffer(ids, "<i4"), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], schema=schema)

    bounded_batches(found.blocks.sparkSession, 16)
    return found.blocks.select("same_id").mapInArrow(run, "a_id long, n_docs long").groupBy("a_id").agg(F.sum("n_docs").alias("n_docs"))


def _odd_counts(found: Alignment) -> DataFrame:
    """pair (a_id * B's size + b_id), n_docs of the other links."""
    return (found.blocks.select(F.explode(F.arrays_zip("pair", "pair_docs")).alias("p"))
            .groupBy(F.col("p.pair").alias("pair")).agg(F.sum("p.pair_docs").alias("n_docs")))


def pair_counts(found: Alignment, a_path: str, b_path: str) -> DataFrame:
    """a_id, b_id, n_docs: how many documents hold the two ids linked."""
    spark, same = found.blocks.sparkSession, aligner(a_path, b_path).same
    ids = spark.createDataFrame([(i, b) for i, b in enumerate(same.tolist()) if b >= 0], "a_id long, b_id long")
    odd = _odd_counts(found).select((F.col("pair") / found.n_b).cast("long").alias("a_id"), (F.col("pair") % found.n_b).alias("b_id"), "n_docs")
    return _same_counts(found).join(ids, "a_id").select("a_id", "b_id", "n_docs").unionByName(odd)


def documents(found: Alignment) -> DataFrame:
    """A row per document: doc_id, FIGURES, n_best, count_sum, groups_sha256.

    ``count_sum`` adds up over the document's links how many documents hold the link's id pair; ``n_best`` are the
    links whose pair no other pair of their A id surpasses in that count.
    """
    spark, n_a, n_b = found.blocks.sparkSession, found.n_a, found.n_b
    odd = store(_odd_counts(found), "alignment-pairs")
    # one figure an A id: bounded by the vocabulary
    same = np.zeros(n_a, np.int64)
    for r in _same_counts(found).collect():
        same[r.a_id] = r.n_docs
    best = same.copy()
    for r in odd.groupBy(F.floor(F.col("pair") / F.lit(n_b)).alias("a_id")).agg(F.max("n_docs").alias("n")).collect():
        best[r.a_id] = max(best[r.a_id], r.n)

    asked = found.blocks.select("block", F.posexplode("pair").alias("code", "pair")).join(odd, "pair")
    back = store(asked.groupBy("block").agg(F.collect_list(F.struct("code", "n_docs")).alias("counts"))
                 .select("block", "counts.code", "counts.n_docs"), "alignment-counts")
    names = ["doc_id", *FIGURES, "n_best", "count_sum"]
    schema = pa.schema([(c, pa.int64()) for c in names] + [("groups_sha256", pa.string())])
    columns = ["doc_id", "groups_sha256", *PACKED, "pair", "code", "n_docs"]

    def run(batches):
        within = lambda values, ends: np.diff(np.concatenate(([0], np.cumsum(values)))[ends], prepend=0)
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(k)[r] for k, c in enumerate(columns)}
                x = {c: np.frombuffer(row[c].as_py(), "<i4").astype(np.int64) for c in PACKED}
                list_of = lambda c: row[c].values.to_numpy() if row[c].is_valid else np.zeros(0, np.int64)
                pair, held = list_of("pair"), np.zeros(len(list_of("pair")), np.int64)
                held[list_of("code")] = list_of("n_docs")
                same_at, odd_at = np.cumsum(x["same_n"]), np.cumsum(x["odd_n"])
                n_odd = held[x["odd_code"]]
                n_same = same[x["same_id"]]
                count_sum = within(x["same_links"] * n_same, same_at) + within(x["odd_links"] * n_odd, odd_at)
                n_best = (within(x["same_links"] * (n_same == best[x["same_id"]]), same_at)
                          + within(x["odd_links"] * (n_odd == best[pair // n_b][x["odd_code"]]), odd_at))
                yield pa.RecordBatch.from_arrays([row["doc_id"].values, *(pa.array(x[c]) for c in FIGURES), pa.array(n_best),
                                                  pa.array(count_sum), row["groups_sha256"].values], schema=schema)

    bounded_batches(spark, 4)  # a row is a block
    scored = found.blocks.drop("pair_docs").join(back, "block", "left").select(*columns).mapInArrow(
        run, ", ".join(f"{c} long" for c in names) + ", groups_sha256 string")
    out = store(scored, "alignment-documents")
    discard(odd, back)
    return out


def q_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    out = documents(found)
    discard(found.blocks)
    return out
