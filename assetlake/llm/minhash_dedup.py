"""MinHash near-dedup with sequential Bayesian verification.

Per document: words, the set of five-word shingles (64-bit hashes), a signature
of ``HASHES`` minima. Documents with equal sets are one class from then on.
Classes that share a band are candidates: each member of a band's bucket is
paired with the bucket's smallest member (a star, linear in the bucket). A pair
is compared a batch of signature values at a time; it is pruned as soon as the
posterior probability of similarity >= THRESHOLD falls below ``MISS``. Survivors
are verified exactly on the full sets.

A star alone could miss a link between two members that are both unlike the
smallest one. Buckets whose members are not all in one component after the star
are therefore compared across components, in cells of about ``CELL`` x ``CELL``
spread over tasks. A cell holds the full sets of its members, so it verifies its survivors
itself, and hands on only links that join two of its components: fewer rows than it has members,
however many pairs of a group reach the threshold, or nearly do. Components are found by distributed union-find.

Defined results: NULL text, or text without words, has the empty set and links
with nothing; rows that repeat a doc_id share its component; a row with a NULL
doc_id links with nothing and stays (component NULL). An empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.common import among, apart, bounded_batches, components, discard, settle, split_buckets, store, table, unclash

WORDS = 5
NUM, DEN = 75, 100
HASHES, ROWS = 200, 5  # 40 bands of 5: a pair at 0.75 is missed with probability 2e-5
STEP = 20
MISS = 1e-6
CELL = 512
FIRST = 2  # likeliest survivors of a document and component that a cell verifies before the others
GROWTH = 32  # times FIRST: probes of a cell compared at once, about 32,768 pairs, 6 MB while a batch of values is compared
ROOM = 1 << 21  # shingles in a block of a cell: 16 MB
COLUMNS = 4096  # distinct shingles of a cell that are counted at once
CHUNK = 4096
SPACES = b" \t\n\r\x0b\x0c"

_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1))[:, None]
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]
_P = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)


class _WordHash(dict):
    def __missing__(self, word):
        import xxhash

        if len(self) >= 100_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _WordHash()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; fewer words are one shingle."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and ASCII white space only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    k = min(n, WORDS)
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out += h[i:n - k + 1 + i] * _P[i]
    return np.unique(_mix(out + np.uint64(k)))


def signature(hashes: np.ndarray) -> np.ndarray:
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), CHUNK):
        np.minimum(out, (low[None, at:at + CHUNK] * _A + _B).min(axis=1), out=out)
    return out


@lru_cache(1)
def least_matches() -> list[int]:
    """Fewest equal values after each batch for which P(similarity >= threshold) is still at least MISS (uniform prior)."""
    t, out = NUM / DEN, []
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < MISS:
            m += 1
            tail += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def survivors(left: np.ndarray, right: np.ndarray, p: np.ndarray, q: np.ndarray):
    """Which pairs (left[p], right[q]) survive every batch, and their equal values. Pruned pairs aren't compared further."""
    alive, matches = np.arange(len(p)), np.zeros(len(p), np.int32)
    for k, least in enumerate(least_matches()):
        part = slice(k * STEP, (k + 1) * STEP)
        matches = matches + (left[p[alive], part] == right[q[alive], part]).sum(axis=1)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive, matches


def passes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row: whether a pair of signatures survives."""
    rows = np.arange(len(left))
    ok = np.zeros(len(left), bool)
    ok[survivors(left, right, rows, rows)[0]] = True
    return ok


def _sigs(column) -> np.ndarray:
    data = b"".join(column.to_pylist() if isinstance(column, pa.Array) else column)
    return np.frombuffer(data, np.uint32).reshape(-1, HASHES)


def features(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_id (128-bit digest of the set), sig."""
    import xxhash

    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("sig", pa.binary())])

    def run(batches):
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                h = shingles(t)
                rows.append((len(h), xxhash.xxh3_128_digest(h.tobytes()), signature(h).tobytes()))
            n, s, g = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(s, pa.binary()), pa.array(g, pa.binary())], schema=schema)

    return unclash(docs, ["doc_id", "text"]).mapInArrow(run, "doc_id long, n_shingles long, set_id binary, sig binary")


def bands(reps: DataFrame) -> DataFrame:
    """(id, bucket): one row per class and band."""
    schema = pa.schema([("id", pa.int64()), ("bucket", pa.int64())])
    n = HASHES // ROWS

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            sig = _sigs(b.column(1)).astype(np.uint64).reshape(-1, n, ROWS)
            key = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64), sig.shape[:2]).copy()
            for r in range(ROWS):
                key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, r])
            ids = np.repeat(b.column(0).to_numpy(), n)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(key.reshape(-1).view(np.int64))], schema=schema)

    return reps.select("id", "sig").mapInArrow(run, "id long, bucket long")


def _bayes(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes allow the threshold and whose signatures survive."""
    reps = among(reps, "id", pairs.select(F.explode(F.array("a", "b")).alias("id")))

    def side(c):
        return reps.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("sig").alias(f"s{c}"))

    rows = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("na", "nb") * DEN >= F.greatest("na", "nb") * NUM).select("a", "b", "sa", "sb")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for x in batches:
            if len(x):
                ok = pa.array(passes(_sigs(x.column(2)), _sigs(x.column(3))))
                yield pa.RecordBatch.from_arrays([x.column(0).filter(ok), x.column(1).filter(ok)], schema=schema)

    return rows.mapInArrow(run, "a long, b long")


def _full_sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, set): the full sets of the documents ``ids`` (distinct), made again from their whole texts."""
    schema = pa.schema([("id", pa.int64()), ("set", pa.binary())])

    def sets(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t).tobytes() for t in b.column(1).to_pylist()], pa.binary())], schema=schema)

    texts = among(docs.select(F.col("doc_id").alias("id"), "text"), "id", ids).join(ids, "id")  # a semi join would be pushed below the mask
    full = store(texts.mapInArrow(sets, "id long, set binary"), "near-sets")
    if not full.groupBy("id").count().where("count > 1").isEmpty():  # a doc_id that repeats: each of its sets once
        full = store(full.dropDuplicates(["id", "set"]), "near-distinct")
    return full


def _verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    ids = store(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near-ids")
    full = _full_sets(ids, docs)
    discard(ids)
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for x in batches:
            ok = []
            for p, q in zip(x.column(2), x.column(3), strict=True):  # views: a batch's sets aren't copied
                p, q = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(DEN * both >= NUM * (len(p) + len(q) - both))
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([x.column(0).filter(ok), x.column(1).filter(ok)], schema=out)

    return (pairs.join(full.select(F.col("id").alias("a"), F.col("set").alias("x")), "a")
            .join(full.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))


def _slices(probe: np.ndarray, comp: np.ndarray, at_once: int):
    """The pairs (probe, member) of a cell that lie in different components, ``at_once`` probes at a time."""
    right = np.flatnonzero(~probe)
    for left in np.array_split(np.flatnonzero(probe), -(-probe.sum() // at_once)) if probe.any() else ():
        p, q = np.nonzero(comp[left][:, None] != comp[right][None, :])
        yield left[p], right[q]


def common(sets: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[p] and sets[q], counted over slices of the shingles that several sets hold."""
    left, p = np.unique(p, return_inverse=True)
    right, q = np.unique(q, return_inverse=True)
    used = [sets[k] for k in (*left.tolist(), *right.tolist())]
    which = np.repeat(np.arange(len(used)), [len(x) for x in used])
    _, at, n = np.unique(np.concatenate(used), return_inverse=True, return_counts=True)
    shared = n[at] > 1
    which, at = which[shared], (np.cumsum(n > 1) - 1)[at[shared]]
    order = np.argsort(at, kind="stable")
    which, at = which[order], at[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for lo in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        s, e = np.searchsorted(at, (lo, lo + COLUMNS))
        held = np.zeros((len(used), COLUMNS), np.float32)  # counts up to COLUMNS are exact
        held[which[s:e], at[s:e] - lo] = 1
        out += (held[:len(left)] @ held[len(left):].T).astype(np.int64)
    return out[p, q]


def _likeliest(p: np.ndarray, comp: np.ndarray, matches: np.ndarray, most: int) -> np.ndarray:
    """Which pairs are among the ``most`` with the most equal values of their probe and component."""
    order = np.lexsort((-matches, comp, p))
    new = np.ones(len(p), bool)
    new[1:] = (np.diff(p[order]) != 0) | (np.diff(comp[order]) != 0)
    starts = np.flatnonzero(new)
    place = np.arange(len(p)) - np.repeat(starts, np.diff(np.append(starts, len(p))))
    out = np.zeros(len(p), bool)
    out[order] = place < most
    return out


def _join(root: list[int], x: np.ndarray, y: np.ndarray) -> list[int]:
    """Joins the components x[k] and y[k] in turn; the places of those that were apart until then."""
    def top(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    out = []
    for k, (c, d) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        c, d = top(c), top(d)
        if c != d:
            root[max(c, d)] = min(c, d)
            out.append(k)
    return out


def _tops(root: list[int]) -> np.ndarray:
    out = np.array(root)
    while (out[out] != out).any():
        out = out[out]
    return out


def cell_links(probe: np.ndarray, comp: np.ndarray, sig: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Verified links (probe, member) of a cell, only those that join components that no link before them joined."""
    size, names = np.array([len(x) for x in sets]), np.unique(comp, return_inverse=True)[1]
    root, links = list(range(len(sets))), [np.empty((2, 0), np.int64)]
    apart = lambda p, q: (now := _tops(root))[names[p]] != now[names[q]]  # noqa: E731  what is joined by now needs no link
    for p, q in _slices(probe, comp, FIRST * GROWTH):
        open_ = apart(p, q)
        p, q = p[open_], q[open_]
        alive, matches = survivors(sig, sig, p, q)
        p, q = p[alive], q[alive]
        first = _likeliest(p, names[q], matches, FIRST)
        for some in (first, ~first):
            some = some & apart(p, q)
            x, y = p[some], q[some]
            if not len(x):
                continue
            both = common(sets, x, y)
            ok = DEN * both >= NUM * (size[x] + size[y] - both)
            x, y = x[ok], y[ok]
            new = _join(root, names[x], names[y])
            links.append(np.stack((x[new], y[new])))
    return tuple(np.concatenate(links, axis=1))


def _linked(rows: DataFrame) -> DataFrame:
    """(a, b): what ``cell_links`` finds in the cells (bucket, blk, pblk, probe, id, comp, sig, set)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(g: pa.Table) -> pa.Table:
        ids, sets = g.column("id").to_numpy(), [np.frombuffer(x.as_buffer(), np.uint64) for x in g.column("set")]
        p, q = cell_links(g.column("probe").to_numpy(), g.column("comp").to_numpy(), _sigs(g.column("sig").to_pylist()), sets)
        return pa.Table.from_arrays([pa.array(np.maximum(ids[p], ids[q])), pa.array(np.minimum(ids[p], ids[q]))], schema=schema)

    return rows.groupBy("bucket", "blk", "pblk").applyInArrow(run, "a long, b long").distinct()


def _across(labelled: DataFrame, links: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """``links`` and those that join the components of ``labelled`` (bucket, id, comp) further."""
    apart = labelled.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("bucket")
    sizes = reps.groupBy("id").agg(F.sum("n").alias("size"))
    open_ = store(labelled.join(apart, "bucket").join(sizes, "id").select("bucket", "id", "comp", "size"), "near-open")
    ids = open_.select("id").distinct()
    full = _full_sets(ids, docs)
    carry = among(reps.select("id", "sig"), "id", ids).join(full, "id")
    return links.unionByName(store(_linked(split_buckets(open_, CELL, carry, ROOM)), "near-linked"))


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document."""
    bounded_batches(docs.sparkSession)
    docs = unclash(docs, ["doc_id", "text"])
    feats = store(features(docs), "near-features")
    narrow = store(feats.drop("sig"), "near-narrow")
    usable = narrow.where("n_shingles > 0 and doc_id is not null")
    classes = store(usable.groupBy("set_id").agg(F.min("doc_id").alias("rep")), "near-classes")
    # a doc_id that repeats with other texts takes part with each of them
    reps = store(feats.where("n_shingles > 0 and doc_id is not null").join(classes, "set_id").where("doc_id = rep").select(F.col("doc_id").alias("id"), "set_id", F.col("n_shingles").alias("n"), "sig")
                 .dropDuplicates(["id", "set_id"]).drop("set_id"), "near-reps")
    discard(feats)
    rows = store(bands(reps), "near-bands")
    buckets = store(rows.groupBy("bucket").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("m")).where("m > 1"), "near-buckets")
    members = store(rows.join(buckets, "bucket").select("bucket", F.col("id").alias("a"), "b"), "near-members")
    discard(rows, buckets)
    pairs = store(members.where("a != b").select("a", "b").distinct(), "near-pairs")
    star = store(_bayes(pairs, reps), "near-star")
    links = store(_verify(star, docs), "near-links")
    discard(pairs, star)
    found = components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), "near-cc")
    labelled = store(members.join(found.withColumnRenamed("node", "a"), "a", "left")
                     .select("bucket", F.col("a").alias("id"), F.coalesce("component_id", "a").alias("comp")), "near-labelled")
    discard(members)
    links = _across(labelled, links, reps, docs)
    same_id = usable.groupBy("doc_id").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi")).where("lo != hi").select("doc_id")
    by_class = usable.join(classes, "set_id").select("doc_id", "rep").where("doc_id != rep")
    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(
        by_class.join(same_id, "doc_id").select(F.col("doc_id").alias("src"), F.col("rep").alias("dst")))
    final = store(components(edges, "near-cc2"), "near-final")
    named = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("set_id", F.coalesce("component_id", "rep").alias("component_id"))
    named = store(named, "near-named")
    return (narrow.join(named, "set_id", "left")
            .withColumn("component_id", F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each component stays (documents without words stay)."""
    gone = settle(lambda: near_components(docs).where("not kept").select(F.col("doc_id").alias("__gone")).distinct(), "near-gone")
    named, others = apart(docs, "doc_id", gone)
    stay = named.join(gone, F.col("doc_id") == F.col("__gone"), "left").where("__gone is null").drop("__gone")  # an anti join would be pushed below the mask
    return others.unionByName(stay)


def q_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))
