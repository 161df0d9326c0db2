"""Language ID with language-bitmask n-gram filters.

Training counts the n-grams of every labelled training text (lower-cased): single
characters and pairs of the scripts of many characters (Han, kana, Hangul),
4-grams of letters elsewhere (a run of anything else is one space). A language
keeps the fewest most frequent n-grams that make up ``COVER`` of its occurrences,
``MAX_GRAMS`` at most, so what is kept is bounded however large the corpus is, and
a language whose n-grams are all rare keeps as many as any other. All languages
share one bit-sliced Bloom filter: ``SLOTS`` rows of one bit per language, in
words of 64 languages; the AND of an n-gram's ``HASHES`` rows is the set of
languages that contain it.

A text's score for a language is the share of its n-grams that the language
contains, corrected for the false positives expected from that language's fill.
The highest decides, ties go to the first language by name.

The pipeline stage rejects relative to each language: it learns from three of the
four training folds, scores the fourth, and rejects texts that score less than
``REJECT`` times the language's ``REJECT_QUANTILE`` there. A language without a
text in that fold rejects nothing but texts of score 0.

Defined results: NULL text or text without a letter is ``und`` with score 0;
a text with letters but no n-gram known anywhere gets the most frequent training
language with score 0; without training rows everything is ``und``. Rows with
NULL lang never train. A NULL doc_id counts as held out of nothing (it trains).
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.common import bounded_batches, store, table, unclash

COVER = 0.98
MAX_GRAMS = 100_000
FREQUENCY_STEPS = 8  # n-grams are ranked by frequency in steps of an eighth of a power of two
SLOTS_LOG2 = 22
HASHES = 3
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
FLUSH = 2_000_000
REJECT = 0.2
REJECT_QUANTILE = 0.01
AT_ONCE = 16  # languages whose n-grams are fetched by one job


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _dense(codes: np.ndarray) -> np.ndarray:
    """Characters of the scripts in which one or two characters make a word: kana, Han, Hangul."""
    return (((codes >= 0x3040) & (codes <= 0x30FF)) | ((codes >= 0x3400) & (codes <= 0x9FFF)) | ((codes >= 0xAC00) & (codes <= 0xD7AF))
            | ((codes >= 0xF900) & (codes <= 0xFAFF)) | (codes >= 0x20000))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram keys of all texts, the number of keys before each text (one more at the end), and whether each has a letter."""
    low = [t.lower() for t in texts]
    # two separators around each text: windows over them hold two neighbouring spaces and drop out
    codes = np.frombuffer(("  " + "  ".join(low) + "  ").encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    dense = letter & _dense(codes)
    some = dense.any()
    sparse = letter & ~dense if some else letter
    c = np.where(sparse, codes & 0xFFFF, 32).astype(np.uint64)
    space = ~sparse
    pairs = space[:-1] & space[1:]
    good = np.flatnonzero(~(pairs[:-2] | pairs[1:-1] | pairs[2:]))
    keys = ((c[:-3] << np.uint64(48)) | (c[1:-2] << np.uint64(32)) | (c[2:-1] << np.uint64(16)) | c[3:])[good]
    if some:  # their keys stay below 2^42, those of 4-grams lie above 2^48
        wide, one, two = codes.astype(np.uint64), np.flatnonzero(dense), np.flatnonzero(dense[:-1] & dense[1:])
        keys = np.concatenate((keys, wide[one], (wide[two] << np.uint64(21)) | wide[two + 1]))
        good = np.concatenate((good, one, two))
        order = np.argsort(good, kind="stable")
        keys, good = keys[order], good[order]
    lens = np.fromiter(map(len, low), np.int64, len(low))
    edges = np.concatenate(([0], np.cumsum(lens + 2)))
    n_letters = np.concatenate(([0], np.cumsum(letter)))
    return keys, np.searchsorted(good, edges), n_letters[edges[1:]] > n_letters[edges[:-1]]


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over whole texts; each task pre-aggregates, Spark sums."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out():
            for lang, (k, n) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.view(np.int64)),
                                                  pa.array(n.astype(np.int64))], schema=schema)
            held.clear()

        for b in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                k, n = np.unique(grams(texts)[0], return_counts=True)
                if lang in held:
                    k0, n0 = held[lang]
                    k, at = np.unique(np.concatenate((k0, k)), return_inverse=True)
                    n = np.bincount(at, np.concatenate((n0, n)), len(k)).astype(np.int64)
                held[lang] = k, n
            if sum(len(k) for k, _ in held.values()) > FLUSH:
                yield from out()
        yield from out()

    rows = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filter:
    """Bit-sliced Bloom filter of all languages' n-grams."""

    def __init__(self, grams_by_lang: dict[str, np.ndarray], frequent: str | None, slots_log2: int = SLOTS_LOG2):
        self.langs = sorted(grams_by_lang)
        kind = np.uint8 if len(self.langs) <= 8 else np.uint64
        self.frequent, self.shift = frequent, np.uint64(64 - slots_log2)
        self.words = [np.zeros(1 << slots_log2, kind) for _ in range(0, max(1, len(self.langs)), 64)]
        for k, lang in enumerate(self.langs):
            for slots in self._slots(grams_by_lang[lang]):
                self.words[k // 64][slots] |= kind(1 << k % 64)
        fill = np.array([(self.words[k // 64] >> kind(k % 64) & kind(1)).mean() for k in range(len(self.langs))])
        self.false_rate = fill ** HASHES

    def _slots(self, keys: np.ndarray):
        for m in MULTIPLIERS[:HASHES]:
            yield ((keys ^ (keys >> np.uint64(29))) * np.uint64(m)) >> self.shift

    def masks(self, keys: np.ndarray) -> list[np.ndarray]:
        """The languages that contain each key, one word per 64 languages."""
        out = None
        for slots in self._slots(keys):
            out = [w[slots] for w in self.words] if out is None else [o & w[slots] for o, w in zip(out, self.words, strict=True)]
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        keys, before, has_letter = grams(texts)
        n = np.maximum(1, np.diff(before))
        masks = self.masks(keys)
        share = np.zeros((len(self.langs), len(texts)))
        for k in range(len(self.langs)):
            word = masks[k // 64]
            hits = np.concatenate(([0], np.cumsum(word >> word.dtype.type(k % 64) & word.dtype.type(1), dtype=np.int64)))
            share[k] = (hits[before[1:]] - hits[before[:-1]]) / n
        share = np.clip((share - self.false_rate[:, None]) / (1 - self.false_rate[:, None]), 0, 1)
        if not self.langs:
            return [("und", 0.0)] * len(texts)
        best = share.argmax(0)
        return [("und", 0.0) if not letter else (self.langs[k], float(share[k, i])) if share[k, i] > 0 else (self.frequent, 0.0)
                for i, (k, letter) in enumerate(zip(best, has_letter, strict=True))]


def frequent_grams(counts: DataFrame, cover: float = COVER, most: int = MAX_GRAMS) -> DataFrame:
    """(lang, gram): the fewest top n-grams of ``counts`` that make up ``cover`` of a language, about ``most`` at most.

    Frequencies are ranked in steps; of the step in which a limit falls, n-grams are taken by hash. The driver
    sees one row per language and step (at most 64 * FREQUENCY_STEPS a language).
    """
    step = F.floor(F.log2("n") * FREQUENCY_STEPS).cast("int")
    ranked = counts.withColumn("step", step)
    steps: dict[str, list] = {}
    for r in ranked.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).collect():
        steps.setdefault(r.lang, []).append((r.step, r.k, r.n))
    limits = []
    for lang, of in steps.items():
        left, wanted = most, cover * sum(n for *_, n in of)
        for s, k, n in sorted(of, reverse=True):
            part = min(1.0, left / k, wanted / n)
            left, wanted = left - k, wanted - n
            if part < 1 or left <= 0 or wanted <= 0:
                break
        limits.append((lang, s, part))
    of_lang = counts.sparkSession.createDataFrame(limits, "lang string, from_step int, part double")
    drawn = F.pmod(F.xxhash64("gram"), F.lit(1 << 30)) < F.col("part") * F.lit(1 << 30)
    return (ranked.join(F.broadcast(of_lang), "lang")  # one row per language
            .where((F.col("step") > F.col("from_step")) | ((F.col("step") == F.col("from_step")) & drawn)).select("lang", "gram"))


def train(docs: DataFrame, most: int = MAX_GRAMS) -> Filter:
    """Fit the filter on (text, lang). What reaches the driver is bounded: about ``most`` n-grams a language."""
    bounded_batches(docs.sparkSession)
    counts = store(count_grams(docs), "lang-grams")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    kept = store(frequent_grams(counts, most=most), "lang-kept")
    found: dict[str, np.ndarray] = {lang: np.zeros(0, np.uint64) for lang in totals}
    langs = sorted(totals)
    for some in (langs[k:k + AT_ONCE] for k in range(0, len(langs), AT_ONCE)):
        got = kept.where(F.col("lang").isin(some)).select(F.array_position(F.array(*map(F.lit, some)), F.col("lang")).cast("short").alias("k"), "gram").toArrow()
        which, keys = (got.column(c).to_numpy() for c in ("k", "gram"))
        found |= {lang: keys[which == k].astype(np.int64).view(np.uint64) for k, lang in enumerate(some, 1)}
    return Filter(found, min(totals, key=lambda k: (-totals[k], k)) if totals else None)


def fold():
    """crc32 of the decimal doc_id modulo 5: 0 is held out, 1 to 4 train."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(1))


def held_out():
    return fold() == 0


def predict(docs: DataFrame, model: Filter, *also: str) -> DataFrame:
    """doc_id, lang_pred, score for every row, then the columns ``also``; only the text is read to predict."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = unclash(docs, ["doc_id", "text", *also])
    made = rows.select("doc_id", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), *also).schema

    def run(batches):
        for b in batches:
            said = shared.value.predict([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in said], pa.string()),
                                              pa.array([y for _, y in said], pa.float64()), *b.columns[2:]], names=["doc_id", "lang_pred", "score", *also])

    return rows.mapInArrow(run, made)


def least_scores(docs: DataFrame, model: Filter) -> dict[str, float]:
    """Per language the score below which a text is rejected, from labelled texts that ``model`` didn't learn from."""
    labelled = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    seen = predict(labelled, model, "lang").where("lang = lang_pred and score > 0")
    return {r.lang: REJECT * r.q for r in seen.groupBy("lang").agg(F.percentile_approx("score", REJECT_QUANTILE, 1000).alias("q")).collect()}


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts that are ``und`` or look like no learned language (by ``least_scores``) go."""
    model = train(docs.where(fold().isin(1, 2, 3)))
    shared = spark.sparkContext.broadcast((model, least_scores(docs.where(fold() == 4), model)))
    spark_schema = docs.schema

    def run(batches):
        model, least = shared.value
        for b in batches:
            said = model.predict([t or "" for t in b.column("text").to_pylist()])
            yield b.filter(pa.array([x != "und" and y > 0 and y >= least.get(x, 0) for x, y in said], pa.bool_()))

    return docs.mapInArrow(run, spark_schema)


def q_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    out = predict(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
