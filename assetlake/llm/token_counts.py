"""Exact token counts at every prefix by dynamic programming (merge-type SentencePiece models with byte fallback).

The encoding of a prefix ends in exactly one piece: of the pieces that end there, the one that re-merging
with the last piece of the prefix before it leaves as it is. So the count at a prefix is one more than the
count where that piece starts, and one pass over a text gives the exact count at every prefix. A count is
stored as its change from the prefix before, one signed byte a character (``steps``); truncation and
budget questions (``counts_at``, ``cut_to``) are answered from the steps alone, without encoding again.

Steps of a chunk that no piece crosses depend on the chunk only, so a word is solved once per worker and
found in a bounded cache afterwards. Whole texts are processed, a block at a time; no row is shuffled.

Defined results: NULL and empty text have no prefix and no token; a prefix is a whole number of characters,
the empty one has no token; counts can fall from one prefix to the next, so ``cut_to`` gives the longest
prefix within the limit. Rows that repeat are counted each; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.common import bounded_batches, table, unclash
from assetlake.llm.sentencepiece_codec import BLOCK_CHARS, SPACE, Codec, _Words, codec

LIMIT = 4096


class PrefixCounter:
    def __init__(self, vocabulary: Codec):
        lone = {c for p in vocabulary.ids for c in p} - vocabulary.ids.keys()
        if lone:
            raise ValueError(f"{len(lone)} characters of pieces are no pieces")
        self.vocabulary = vocabulary
        self.words = _Words(self._word)

    def _segment(self, s: str) -> list[int]:
        """Token counts of every prefix of a string of known characters."""
        ends: list[list[str]] = [[] for _ in s]
        for end, piece in self.vocabulary.trie.iter(s):
            ends[end].append(piece)
        fits, last, counts = self.vocabulary.fits, [], [0]
        for end, pieces in enumerate(ends):
            for piece in pieces:
                start = end + 1 - len(piece)
                if not start or fits(last[start - 1], piece):
                    last.append(piece)
                    counts.append(counts[start] + 1)
                    break
            else:
                raise ValueError(f"no piece ends the prefix {s[:end + 1]!r}")
        return counts

    def _word(self, word: str) -> bytes:
        """Change of the count with each character of a chunk."""
        steps, known, joins, start, n = array("b"), self.vocabulary.ids, self.vocabulary.joins, 0, len(word)
        for k in range(1, n + 1):
            if k < n and word[k - 1:k + 1] in joins:
                continue
            s, start = word[start:k], k
            if len(s) == 1:
                steps.append(1 if s in known else len(s.encode()))
            else:
                counts = self._segment(s)
                steps.extend(b - a for a, b in zip(counts, counts[1:], strict=False))
        return steps.tobytes()

    def steps(self, text: str) -> bytes:
        """Change of the token count with each character of a whole text."""
        if not text:
            return b""
        text = SPACE + text.replace(" ", SPACE)
        word, chunk, at, parts = self.words.__getitem__, self.vocabulary.chunk, 0, []
        while at < len(text):
            to = at + BLOCK_CHARS
            while to < len(text) and not (text[to] == SPACE and text[to - 1] != SPACE):
                to += 1
            parts += map(word, chunk.findall(text, at, to))
            at = to
        found = b"".join(parts)
        first = (found[0] + found[1] + 128) % 256 - 128  # the space that encoding adds belongs to the first character
        return array("b", [first]).tobytes() + found[2:]


@lru_cache(maxsize=2)
def counter(model_path: str) -> PrefixCounter:
    """One counter per worker and model."""
    return PrefixCounter(codec(model_path))


def counts(steps: bytes) -> np.ndarray:
    """Token count at every prefix, the empty one included."""
    return np.concatenate(([0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)))


def prefix_table(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, steps (one signed byte a character)."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("steps", pa.binary())])

    def run(batches):
        c = counter(model_path)
        for b in batches:
            steps = [c.steps(t or "") for t in b.column(1).to_pylist()]
            n_bytes = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            totals = [int(np.frombuffer(s, np.int8).sum(dtype=np.int64)) for s in steps]
            yield pa.RecordBatch.from_arrays([b.column(0), n_bytes, pa.array(totals, pa.int64()), pa.array(steps, pa.binary())],
                                             schema=schema)

    return unclash(docs, ["doc_id", "text"]).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, steps binary")


def counts_at(prefixes: DataFrame, chars: str) -> DataFrame:
    """Adds ``tokens_at``: the token counts of the prefixes whose lengths in characters the array column ``chars`` lists.

    Lengths beyond the text count the whole text, negative ones the empty prefix; NULL lengths and lists give NULL.
    """
    @F.pandas_udf("array<long>")
    def at(steps, lengths):
        import pandas as pd

        out = []
        for s, wanted in zip(steps, lengths, strict=True):
            have = counts(s)
            out.append(None if wanted is None else [None if w is None or w != w else int(have[min(max(int(w), 0), len(s))]) for w in wanted])
        return pd.Series(out)

    return prefixes.withColumn("tokens_at", at("steps", F.col(chars)))


def cut_to(prefixes: DataFrame, limit: int) -> DataFrame:
    """Adds ``fit_chars`` and ``fit_tokens``: the longest prefix of at most ``limit`` tokens, and its count."""
    if limit < 0:
        raise ValueError("limit must not be negative")

    @F.pandas_udf("fit_chars long, fit_tokens long")
    def longest(steps):
        import pandas as pd

        out = []
        for s in steps:
            have = counts(s)
            n = int(np.flatnonzero(have <= limit)[-1])
            out.append((n, int(have[n])))
        return pd.DataFrame(out, columns=["fit_chars", "fit_tokens"])

    return prefixes.withColumn("fit", longest("steps")).select(*prefixes.columns, "fit.fit_chars", "fit.fit_tokens")


def over(prefixes: DataFrame, limit: int) -> DataFrame:
    """Adds ``over_limit``: whether the whole text has more than ``limit`` tokens."""
    return prefixes.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = prefix_table(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return over(found, LIMIT).select("doc_id", "n_bytes", "n_tokens", "over_limit")
