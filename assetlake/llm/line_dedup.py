"""Fuzzy line dedup by MinHash, in DataFrame functions alone.

A line's shingles are the windows of ``SHINGLE`` bytes of its trimmed UTF-8 text
(the whole line if shorter). Equal lines are one. A signature value is the
smallest of the shingle hashes, hashed again with a seed; one such 64-bit hash
gives ``TURNS`` values, by its rotations: each orders the shingles by other bits,
so that even the minima of a few shingles are independent. ``ROWS`` values make a band. Lines that share a
band are candidates: each member of a bucket against the bucket's smallest one.
Candidates whose signatures agree in fewer values than a pair at the threshold does
but with probability MISS (told from a byte of each value) are left out, the others
verified exactly on the full shingle sets. Buckets that are not in one component
then are compared across components, in cells over many tasks. Union-find gives
the components; the line with the smallest (doc_id, line number) of each stays.

Defined results: NULL text has no line; blank lines are no duplicates and stay;
lines under SHINGLE bytes are duplicates only when equal; rows that repeat a
doc_id and text carry the same flags; NULL doc_ids
come last. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from math import comb

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.common import components, discard, split_buckets, store, table, tidy, unclash

SHINGLE = 5  # one changed character leaves lines of 39 bytes or more similar
NUM, DEN = 75, 100
BANDS, ROWS = 19, 5  # a pair at 0.75 is a candidate with 0.994, at 0.85 with 0.99997; over 100 columns Spark generates no code
TURNS = 4
MISS = 1e-9
LANES = 7  # bytes of signature values in a long of the sketch; sums of them don't reach its sign
CELL = 256
SMALL_BYTES = 32 << 20  # a key set at most this large may be broadcast


def _seeds() -> list[int]:
    """Points spread over the 64-bit range: the golden ratio sequence."""
    return [((k * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) - (1 << 63) for k in range(1, -(-BANDS * ROWS // TURNS) + 1)]


def _turned(x, k: int):
    """A long rotated by k parts of ``TURNS``."""
    n = 64 // TURNS * k
    return F.shiftleft(x, n).bitwiseOR(F.shiftrightunsigned(x, 64 - n)) if n else x


def least_equal() -> int:
    """Fewest equal signature values that a pair at the threshold has, but with probability MISS."""
    n, t = BANDS * ROWS, NUM / DEN
    tail, m = 0.0, -1
    while tail < MISS:
        m += 1
        tail += comb(n, m) * t ** m * (1 - t) ** (n - m)
    return m


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line, h1, h2): the trimmed lines of whole texts."""
    d = unclash(docs, ["doc_id", "text"]).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    d = d.withColumn("line", F.trim("raw")).drop("raw")
    # 128 bits tell lines apart
    return d.withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(1), "line"))


def _hashes(line):
    """Hashes of all windows; O(length): bytes are addressed directly, and as a lambda's variable, since a column's are copied for each window."""
    n = F.octet_length(line)
    starts = F.sequence(F.lit(1), F.greatest(n - (SHINGLE - 1), F.lit(1)))
    return F.flatten(F.transform(F.array(line.cast("binary")), lambda b: F.transform(starts, lambda i: F.xxhash64(F.substring(b, i, F.lit(SHINGLE))))))


def signatures(rows: DataFrame) -> DataFrame:
    """(id, h1, h2, bands, sketch): one row per distinct line of at least SHINGLE bytes."""
    once = (rows.where(F.octet_length("line") >= SHINGLE).select("h1", "h2", F.col("line").cast("binary").alias("b"))
            .groupBy("h1", "h2").agg(F.first("b").alias("b")))
    # the distinct lines are dealt by (h1, h2) already, so their minima need no further exchange
    cut = once.select("h1", "h2", "b", F.explode(F.sequence(F.lit(1), F.octet_length("b") - (SHINGLE - 1))).alias("i"))
    value = cut.select("h1", "h2", F.xxhash64(F.substring("b", F.col("i"), F.lit(SHINGLE))).alias("h"))
    mixed = value.select("h1", "h2", *[F.xxhash64(F.col("h").bitwiseXOR(F.lit(s))).alias(f"x{k}") for k, s in enumerate(_seeds())])
    # with the sketch's bytes, over 100 columns leave the last step of the aggregation and what follows out of Spark's
    # whole-stage code: as one method it would be too long for the JVM to compile and run interpreted for each line
    least = [F.min(_turned(F.col(f"x{k // TURNS}"), k % TURNS)) for k in range(BANDS * ROWS)]
    mins = mixed.groupBy("h1", "h2").agg(*[m.alias(f"m{k}") for k, m in enumerate(least)],
                                         *[m.bitwiseAND(F.lit(0xFF).cast("long")).alias(f"l{k}") for k, m in enumerate(least)]).withColumn("id", F.monotonically_increasing_id())
    bands = F.array(*[F.xxhash64(F.lit(b), *[f"m{b * ROWS + r}" for r in range(ROWS)]) for b in range(BANDS)])
    sketch = F.array(*[reduce(lambda x, y: x.bitwiseOR(y), [F.shiftleft(f"l{k}", 8 * (k % LANES)) for k in range(at, min(at + LANES, BANDS * ROWS))])
                       for at in range(0, BANDS * ROWS, LANES)])
    return mins.select("id", "h1", "h2", bands.alias("bands"), sketch.alias("sketch"))


def likely(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """Pairs (a, b) of ids whose sketches agree in at least ``least_equal`` bytes."""
    def side(c):  # the longs as columns: with arrays, the comparison is too long a method for the JVM to compile
        return sigs.select(F.col("id").alias(c), *[F.col("sketch")[j].alias(f"k{c}{j}") for j in range(-(-BANDS * ROWS // LANES))])

    low, high = F.lit(int("7f" * LANES, 16)), F.lit(int("80" * LANES, 16))

    def unequal(j):  # bytes that differ: their high bit is set, by the sum or itself
        x = F.col(f"ka{j}").bitwiseXOR(F.col(f"kb{j}"))
        return F.bit_count((x.bitwiseAND(low) + low).bitwiseOR(x).bitwiseAND(high))

    n = reduce(lambda x, y: x + y, [unequal(j) for j in range(-(-BANDS * ROWS // LANES))])
    return pairs.join(side("a"), "a").join(side("b"), "b").where(n <= BANDS * ROWS - least_equal()).select("a", "b")


def _verify(pairs: DataFrame, sigs: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """Pairs (a, b) of ids whose full shingle sets reach the threshold."""
    pairs = store(likely(pairs, sigs), f"{name}-likely")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    keys = store(sigs.select("id", "h1", "h2").join(ids, "id"), f"{name}-keys")
    small = keys.count() * 32 <= SMALL_BYTES
    need = F.broadcast(keys) if small else keys
    texts = store(rows.select("h1", "h2", "line").join(need, ["h1", "h2"]).groupBy("id").agg(F.first("line").alias("line")), f"{name}-texts")

    def side(c):
        return texts.select(F.col("id").alias(c), F.col("line").alias(f"l{c}"))

    # the texts are moved, since sets take eight times their room; an array of one has each set, and what they share, made once
    sets = F.struct(*[F.array_distinct(_hashes(F.col(f"l{c}"))).alias(f"s{c}") for c in ("a", "b")])
    na, nb, both = F.size("s.sa"), F.size("s.sb"), F.col("both")
    found = (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", F.explode(F.array(sets)).alias("s"))
             .where(F.least(na, nb) * DEN >= F.greatest(na, nb) * NUM)
             .select("a", "b", (na + nb).alias("n"), F.explode(F.array(F.size(F.array_intersect("s.sa", "s.sb")))).alias("both"))
             .where(both * DEN >= (F.col("n") - both) * NUM))
    out = store(found.select("a", "b"), f"{name}-links")
    discard(pairs, keys, texts)
    return out


def line_components(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, kept, keep_doc_id, keep_line_no, copies: one row per line of every document."""
    rows = lines(docs)
    sigs = store(signatures(rows), "line-sigs")
    tidy(docs.sparkSession)  # the shuffled lines
    exploded = sigs.select("id", F.explode("bands").alias("bucket"))
    buckets = store(exploded.groupBy("bucket").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("m")).where("m > 1"), "line-buckets")
    tidy(docs.sparkSession)
    members = store(exploded.join(buckets, "bucket").select("bucket", F.col("id").alias("a"), "b"), "line-members")
    star = store(members.where("a != b").select("a", "b").distinct(), "line-star")
    discard(buckets)
    tidy(docs.sparkSession)
    links = _verify(star, sigs, rows, "line")
    found = components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), "line-cc")
    labelled = store(members.join(found.withColumnRenamed("node", "a"), "a", "left")
                     .select("bucket", F.col("a").alias("id"), F.coalesce("component_id", "a").alias("comp")), "line-labelled")
    discard(members)
    tidy(docs.sparkSession)
    cells = split_buckets(labelled, CELL)
    left, right = cells.where("probe").alias("l"), cells.where("not probe").alias("r")
    across = (left.join(right, ["bucket", "blk", "pblk"]).where("l.comp != r.comp")
              .select(F.greatest("l.id", "r.id").alias("a"), F.least("l.id", "r.id").alias("b")).distinct())
    across = store(across.join(star, ["a", "b"], "left_anti"), "line-across")
    discard(labelled, star)
    more = _verify(across, sigs, rows, "line-more")
    discard(across)
    tidy(docs.sparkSession)
    final = components(links.unionByName(more).select(F.col("a").alias("src"), F.col("b").alias("dst")), "line-cc2")
    named = store(sigs.select("id", "h1", "h2").join(final.withColumnRenamed("node", "id"), "id").select("h1", "h2", F.col("component_id").alias("cc")), "line-named")
    discard(sigs, links, more)
    narrow = store(rows.select("doc_id", "line_no", "h1", "h2", (F.col("line") == "").alias("blank")), "line-narrow")
    # a line without partner is its own component, named by its digests
    per_line = narrow.where("not blank").groupBy("h1", "h2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "line_no")).alias("first"), F.count(F.lit(1)).alias("copies"))
    per_line = store(per_line.join(named, ["h1", "h2"], "left"), "line-digests")
    grouped = store(per_line.where("cc is not null").groupBy("cc").agg(F.min("first").alias("gfirst"), F.sum("copies").alias("gcopies")), "line-groups")
    decided = store(per_line.join(grouped, "cc", "left").select(
        "h1", "h2", F.coalesce("gfirst", "first").alias("first"), F.coalesce("gcopies", "copies").alias("copies")), "line-decided")
    told = narrow.where("not blank").join(decided, ["h1", "h2"]).select(
        "doc_id", "line_no", F.col("first.doc_id").alias("keep_doc_id"), F.col("first.line_no").alias("keep_line_no"), "copies")
    blank = narrow.where("blank").select("doc_id", "line_no", F.col("doc_id").alias("keep_doc_id"), F.col("line_no").alias("keep_line_no"), F.lit(1).cast("long").alias("copies"))
    return told.unionByName(blank).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_doc_id")) & (F.col("line_no") == F.col("keep_line_no")))


def rebuild(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Documents with the dropped lines taken out of their texts."""
    gone = decisions.where("not kept").groupBy("doc_id").agg(F.collect_set("line_no").alias("__gone")).withColumnRenamed("doc_id", "__id")
    parts = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "__gone")
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n"))
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")), "left").withColumn("text", text).select(*docs.columns)


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_components(table(spark, sf_dir, "documents"))
