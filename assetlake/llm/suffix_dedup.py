"""Removal of repeated substrings by distributed prefix doubling.

Every byte that a ``min_bytes`` string covers which starts anywhere else too is
removed. Ranking every byte position would move many times the corpus, so the
positions that are ranked are the starts of content-defined chunks: a chunk
begins where a hash of the ``CONTEXT`` bytes before says so, hence equal strings
are cut alike (all but their first CONTEXT bytes).

Level 0 ranks chunks, level k runs of 2^k chunks: Spark sorts the distinct rank
pairs (rank of the run, rank of the run 2^(k-1) chunks on), gives those that
occur more than once their place in the order as new rank, and drops a position
once its run is unique or past ``min_bytes``. What that decides:

* a run of at least min_bytes that occurs elsewhere covers all windows in it;
* a window that holds a unique run whole is unique.

What is left are windows that overlap the ends of a repeat by less than a chunk
(and the rare ones without a whole chunk): their 96-bit digests are counted,
together with those of the covered windows that could equal one of them, taken
from one place of each repeated run. The result is exact for every byte; texts
equal as a whole are ranked once.

Defined results: NULL text is empty; texts under min_bytes lose nothing but are
still no place a window could start; repeated rows are equal texts, each loses
all; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetlake.llm.common import bounded_batches, discard, fresh_path, store, table, tidy, unclash

MIN_BYTES = 400
CONTEXT = 16
MEAN_CHUNK = 24

_GEAR = np.random.default_rng(77).integers(0, 1 << 32, 256, dtype=np.uint32)
KEY = ["uid", "u2"]


def chunk_starts(data: bytes, mean: int = MEAN_CHUNK) -> np.ndarray:
    """Positions whose CONTEXT preceding bytes hash below 1 / mean."""
    if len(data) <= CONTEXT:
        return np.empty(0, np.int64)
    h = _GEAR[np.frombuffer(data, np.uint8)]
    step = 1
    while step < CONTEXT:  # after the loop, h[i] mixes the CONTEXT bytes from i on
        h = h[:-step] + (h[step:] * np.uint32((2 * step * 0x9E3779B1 | 1) & 0xFFFFFFFF))
        step *= 2
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return np.flatnonzero(h < np.uint32((1 << 32) // mean)) + CONTEXT


def distinct_texts(docs: DataFrame, min_bytes: int) -> DataFrame:
    """uid, u2, copies, text of the distinct texts that a window fits in, bucketed by (uid, u2): the joins of
    what is found with the texts then move no text."""
    spark = docs.sparkSession
    long_ = docs.where(F.octet_length("text") >= min_bytes).select(F.xxhash64("digest").alias("uid"), F.hash("digest").alias("u2"), "digest", "text")
    # grouped by the columns that they are dealt by, so the texts are shuffled once
    rows = long_.groupBy(*KEY).agg(F.first("digest").alias("digest"), F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
    name, n = f"suffix_texts_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartition(n, *KEY).write.bucketBy(n, *KEY).sortBy(*KEY).option("path", fresh_path(spark, "suffix-texts"))
     .option("compression", "zstd").format("parquet").saveAsTable(name))
    tidy(spark)
    return spark.table(name)


def chunks(texts: DataFrame, mean: int) -> DataFrame:
    """uid, u2, i, len, h: the chunks of every text in order."""
    import xxhash

    schema = pa.schema([("uid", pa.int64()), ("u2", pa.int32()), ("i", pa.int32()), ("len", pa.int32()), ("h", pa.int64())])

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for uid, u2, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                data = t.encode()
                at = chunk_starts(data, mean)
                n = len(at) - 1
                if n < 1:
                    continue
                edges = at.tolist()
                h = np.fromiter((digest(data[s:e]) for s, e in zip(edges, edges[1:], strict=False)), np.uint64, n)
                for col, x in zip(out, (np.full(n, uid, np.int64), np.full(n, u2, np.int32), np.arange(n, dtype=np.int32), np.diff(at).astype(np.int32), h.view(np.int64)), strict=True):
                    col.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=schema)

    return texts.select(*KEY, "text").mapInArrow(run, "uid long, u2 int, i int, len int, h long")


def _rank(rows: DataFrame, keys: list[str], min_bytes: int, name: str) -> DataFrame:
    """Keys that occur more than once, sorted, with their place in the order as rank and, for runs of at least
    ``min_bytes`` (no other needs it), the first position of each."""
    again = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    place = rows.where(F.col("len") >= min_bytes).groupBy(*keys).agg(F.min(F.struct(*KEY, "i")).alias("place"))
    ranks = store(again.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), f"{name}-order")
    out = store(ranks.join(place, keys, "left"), name)
    discard(ranks)
    tidy(rows.sparkSession)
    return out


def double(rows: DataFrame, min_bytes: int) -> DataFrame:
    """uid, u2, codes: what the levels found about each text's runs.

    A code is level << 34 | first << 33 | unique << 32 | chunk: repeated chunks (level 0), unique runs (level 1 and
    up) and repeated runs of at least min_bytes; ``first`` marks the first place of a repeated run of at least min_bytes.
    """
    spark = rows.sparkSession

    def code(k, unique):
        first = F.coalesce(F.col("first"), F.lit(False)).cast("long") * F.lit(1 << 33)
        return (F.lit((k << 34) | (unique << 32)).cast("long") + first + F.col("i")).alias("code")

    here = (F.struct(*KEY, "i") == F.col("place")).alias("first")
    ranks = _rank(rows, ["h"], min_bytes, "suffix-rank0")
    cur = store(rows.join(ranks, "h").select(*KEY, "i", "len", F.col("rank").alias("r"), here), "suffix-level0")
    found, level, over = [cur.select(*KEY, code(0, 0))], 0, [cur]
    discard(ranks)
    tidy(spark)
    while not cur.where(F.col("len") < min_bytes).isEmpty():
        step = 1 << level
        level += 1
        order = Window.partitionBy(*KEY).orderBy("i")
        ahead, behind = order.rangeBetween(step, step), order.rangeBetween(-step, -step)
        pairs = (cur.withColumn("r2", F.first("r").over(ahead)).withColumn("len2", F.first("len").over(ahead))
                 .withColumn("left", F.first("len").over(behind)))
        # past min_bytes a position goes on only while a shorter run on its left still needs its rank
        pairs = pairs.where((F.col("len") < min_bytes) | (F.col("left") < min_bytes))
        pairs = store(pairs.where("r2 is not null").select(*KEY, "i", (F.col("len") + F.col("len2")).alias("len"), "r", "r2"), "suffix-pairs")
        ranks = _rank(pairs, ["r", "r2"], min_bytes, "suffix-rank")
        told = store(pairs.join(ranks, ["r", "r2"], "left").select(*KEY, "i", "len", "rank", here), "suffix-told")
        discard(pairs, ranks)
        over.append(told)
        found.append(told.where("rank is null").select(*KEY, code(level, 1)))
        cur = told.where("rank is not null").withColumnRenamed("rank", "r")
        found.append(cur.where(F.col("len") >= min_bytes).select(*KEY, code(level, 0)))
        tidy(spark)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    codes = store(out.groupBy(*KEY).agg(F.collect_list("code").alias("codes")), "suffix-codes")
    discard(*over)
    return codes


def decide(data: bytes, codes: np.ndarray, min_bytes: int, mean: int):
    """For each window start of a text: whether it is known to be repeated, whether by the first place of a run, whether
    it is undecided; then the chunk starts, and the first chunk that lies in the window whole (-1: none)."""
    w = len(data) - min_bytes + 1
    at = chunk_starts(data, mean)
    accept, first, reject = (np.zeros(w + 1, np.int32) for _ in range(3))

    def mark(into, a, b):
        a, b = np.maximum(a, 0), np.minimum(b, w - 1)
        ok = a <= b
        np.add.at(into, a[ok], 1)
        np.add.at(into, b[ok] + 1, -1)
        return np.cumsum(into[:w]) > 0

    m = max(0, len(at) - 1)
    i, level, place, unique = codes & 0xFFFFFFFF, codes >> 34, (codes >> 33) & 1 == 1, (codes >> 32) & 1 == 1
    again = np.zeros(m, bool)
    again[i[(level == 0) & ~unique]] = True
    lone = np.flatnonzero(~again)
    # a unique run inside a window, behind the bytes that place its cuts, makes the window unique
    starts = np.concatenate((at[lone], at[i[unique]]))
    ends = np.concatenate((at[lone + 1], at[i[unique] + (1 << level[unique])]))
    no = mark(reject, ends - min_bytes, starts - CONTEXT)
    starts, ends = at[i[~unique]], at[i[~unique] + (1 << level[~unique])]
    yes = mark(accept, starts, ends - min_bytes)
    place = place[~unique]
    rep = mark(first, starts[place], ends[place] - min_bytes)
    p = np.arange(w)
    inner = np.searchsorted(at, p + CONTEXT)
    if m:
        inner = np.where((inner < m) & (at[np.minimum(inner + 1, m)] <= p + min_bytes), inner, -1)
    else:
        inner[:] = -1
    return yes, rep, ~yes & ~no, at, inner


def windows(rows: DataFrame, min_bytes: int, mean: int, flagged: bool) -> DataFrame:
    """uid, u2, p, d1, d2, h: digests of windows and of the first chunk inside.

    All undecided windows and those without a whole chunk; with ``flagged``, the windows covered by the first place
    of a run whose first chunk inside is one of ``flags`` instead.
    """
    import xxhash

    schema = pa.schema([("uid", pa.int64()), ("u2", pa.int32()), ("p", pa.int32()), ("d1", pa.int64()), ("d2", pa.int32()), ("h", pa.int64())])

    def run(batches):
        digest, short = xxhash.xxh3_128_digest, xxhash.xxh3_64_intdigest
        for b in batches:
            for uid, u2, t, codes, flags in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                data = t.encode()
                yes, rep, open_, at, inner = decide(data, np.array(codes or [], np.int64), min_bytes, mean)
                wanted = rep & np.isin(inner, np.array(flags or [], np.int64)) if flagged else open_ | (yes & (inner < 0))
                p = np.flatnonzero(wanted).astype(np.int32)
                chunk: dict[int, int | None] = {-1: None}
                for k in range(0, len(p), 1 << 16):
                    q = p[k:k + (1 << 16)]
                    d = np.frombuffer(b"".join(digest(data[x:x + min_bytes]) for x in q.tolist()), np.int64).reshape(-1, 2)
                    ins = inner[q].tolist()
                    for c in set(ins) - chunk.keys():
                        x = short(data[at[c]:at[c + 1]])
                        chunk[c] = x - (1 << 64) if x >> 63 else x
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), uid, np.int64)), pa.array(np.full(len(q), u2, np.int32)), pa.array(q),
                                                      pa.array(d[:, 0].copy()), pa.array(d[:, 1].astype(np.int32)), pa.array([chunk[c] for c in ins], pa.int64())], schema=schema)

    return rows.select(*KEY, "text", "codes", "flags").mapInArrow(run, "uid long, u2 int, p int, d1 long, d2 int, h long")


def remove(data: bytes, yes: np.ndarray, min_bytes: int) -> tuple[int, list[tuple[int, int]], bytes]:
    """Bytes removed, maximal removed runs and the rest of a text, given its repeated windows."""
    p = np.flatnonzero(yes)
    if not len(p):
        return 0, [], data
    breaks = np.flatnonzero(np.diff(p) > min_bytes)
    first = p[np.concatenate(([0], breaks + 1))].tolist()
    last = (p[np.concatenate((breaks, [len(p) - 1]))] + min_bytes).tolist()
    spans = list(zip(first, last, strict=True))
    kept, at = [], 0
    for s, e in spans:
        kept.append(data[at:s])
        at = e
    kept.append(data[at:])
    return sum(e - s for s, e in spans), spans, b"".join(kept)


def dedup(docs: DataFrame, min_bytes: int = MIN_BYTES, mean: int = MEAN_CHUNK, with_rest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256[, spans, rest]: one row per document."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = unclash(docs, ["doc_id", "text"]).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    texts = distinct_texts(docs, min_bytes)
    cut = store(chunks(texts, mean), "suffix-chunks")
    told = texts.join(double(cut, min_bytes), KEY, "left")
    open_ = store(windows(told.withColumn("flags", F.lit(None).cast("array<int>")), min_bytes, mean, False), "suffix-windows")
    # a window covered by a repeated run may equal an undecided one: both have the same first chunk inside
    looked = store(open_.where("h is not null").select("h").distinct(), "suffix-looked")
    flags = store(cut.join(looked, "h").groupBy(*KEY).agg(F.collect_list("i").alias("flags")), "suffix-flags")
    discard(cut, looked)
    tidy(spark)
    covered = store(windows(told.join(flags, KEY), min_bytes, mean, True), "suffix-covered")
    again = store(open_.unionByName(covered).groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "suffix-again")
    hits = store(open_.join(again, ["d1", "d2"]).groupBy(*KEY).agg(F.collect_list("p").alias("hits")), "suffix-hits")
    discard(open_, covered, again)
    tidy(spark)
    schema = pa.schema([("d", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
                       + [("spans", pa.list_(pa.list_(pa.int64()))), ("rest", pa.binary())] * with_rest)

    def run(batches):
        for b in batches:
            rows = []
            for d, copies, t, c, h in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                data = t.encode()
                if copies > 1:
                    n, spans, rest = len(data), [(0, len(data))], b""
                else:
                    yes = decide(data, np.array(c or [], np.int64), min_bytes, mean)[0]
                    yes[np.array(h or [], np.int64)] = True
                    n, spans, rest = remove(data, yes, min_bytes)
                rows.append((d, n, len(spans), hashlib.sha256(rest).hexdigest(), *((spans, rest) if with_rest else ())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    ddl = "d binary, n_removed long, n_spans long, kept_sha256 string" + (", spans array<array<long>>, rest binary" if with_rest else "")
    done = store(told.join(hits, KEY, "left").select("digest", "copies", "text", "codes", "hits").mapInArrow(run, ddl), "suffix-done")
    narrow = docs.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    out = narrow.join(done, F.col("digest") == F.col("d"), "left")
    zero = F.lit(0).cast("long")
    extra = [F.col("spans"), F.col("rest")] if with_rest else []
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
                      F.coalesce("kept_sha256", F.lower(F.hex("digest"))).alias("kept_sha256"), *extra)


def q_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
