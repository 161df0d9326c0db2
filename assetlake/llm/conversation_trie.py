"""Prefix trie of conversations by ternary search trees over range shards.

A conversation is the sequence of its turns (role, text); a node is a distinct prefix. ``trie`` returns a row per
node with its members, children, leaves and the tokens that sharing prefixes saves.

1. A turn becomes the 128-bit digest of its role and text and its word count; texts move no further. Turns are
   range-sorted by (conversation, turn), so a conversation of any length spreads over tasks, and are gathered to
   pieces of at most ``SEGMENT`` turns (``pieces``). Where a piece starts follows from the sizes of the pieces before it.
2. ``sequences`` joins the pieces of a conversation. Of a long one (more than a piece) only as much is joined as others
   may share: an order-free fingerprint of its first 2, 8, 32 ... ``SEGMENT`` turns shows where it is alone. What
   follows is a chain of nodes with one member, written straight from the pieces.
3. Sequences are range-sorted over shards. A shard encodes its digests by a dictionary and inserts its distinct
   sequences into a ternary search tree, the median first and so on in either half, which balances it; one pass
   over the nodes, children before parents, adds up members, leaves and savings. Nodes off the paths of the shard's
   first and last sequence lie in no other shard and are done.
4. The nodes on those two paths are merged by their path's digest: members and the figures of finished children are summed,
   then subtree sums over the merged nodes take log2(depth) rounds of joins (each adds what lies 2^k levels below).
   Ids of members that end at a merged node arrive as texts in order, one a shard, and are hashed as a stream.

A group of copies may hold any share of the conversations: copies lie in several shards and meet as one row a shard.

Defined results: rows without conv_id belong to no conversation and are left out; turns are ordered by turn (NULL first),
equal turn numbers by the digest; c % group of a negative c is negative (SQL); a NULL role or text is empty; rows that repeat are a turn each; extra columns are
ignored; an empty table has no node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetlake.llm.common import bounded_batches, discard, store, table

SEGMENT = 512
SHARD_TURNS = 1 << 17
ROOT = bytes(16)
EMPTY = hashlib.sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"


def turn_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest (16 bytes of role and text), words."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.unhex(F.substring(F.sha2(said, 256), 1, 32)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def pieces(turns: DataFrame) -> DataFrame:
    """conv_id, part, start, total, n, digs, words: the turns of a conversation in pieces, in order of ``part``.

    ``start`` is the number of turns before the piece, ``total`` all of the conversation's; ``digs`` and ``words`` hold
    16 and 8 bytes a turn.
    """
    spark = turns.sparkSession
    bounded_batches(spark, 8192)
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("n", pa.int64()), ("digs", pa.binary()), ("words", pa.binary()),
                        ("whole", pa.bool_())])

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 33
        conv, digs, words, alone, rows = None, b"", b"", False, []

        def flush(whole):
            nonlocal digs, words, part
            rows.append((conv, part, len(digs) >> 4, digs, words, whole))
            digs, words, part = b"", b"", part + 1

        def out():
            done = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(done, schema=schema)

        first = True
        for b in batches:
            ids, said, counted = b.column(0).to_numpy(), b"".join(b.column(1).to_pylist()), b.column(2).to_numpy().tobytes()
            edges = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for s, e in zip(edges, edges[1:], strict=False):
                if e > s and ids[s] != conv:
                    if conv is not None:
                        if digs:
                            flush(alone)
                        first = False
                    conv, alone = int(ids[s]), not first  # the first one may have begun in the task before
                while s < e:
                    to = min(e, s + SEGMENT - (len(digs) >> 4))
                    digs, words, s = digs + said[16 * s:16 * to], words + counted[8 * s:8 * to], to
                    if len(digs) >> 4 == SEGMENT:
                        alone = False
                        flush(False)
                if len(rows) >= 4096:
                    yield out()
        if digs:
            flush(False)  # the last one may go on in the next task
        if rows:
            yield out()

    sorted_ = turns.repartitionByRange("conv_id", "turn", "digest").sortWithinPartitions("conv_id", "turn", "digest")
    found = store(sorted_.select("conv_id", "digest", "words").mapInArrow(
        run, "conv_id long, part long, n long, digs binary, words binary, whole boolean"), "trie-pieces")
    each = Window.partitionBy("conv_id")
    broken = found.where("NOT whole").select("conv_id", "part", "n").select(
        "part", (F.sum("n").over(each.orderBy("part")) - F.col("n")).alias("start"), F.sum("n").over(each).alias("total"))
    columns = ["conv_id", "part", "start", "total", "n", "digs", "words"]
    return (found.where("whole").withColumn("start", F.lit(0).cast("long")).withColumn("total", F.col("n")).select(*columns)
            .unionByName(found.where("NOT whole").join(broken, "part").select(*columns)))


def share_heads(found: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Pieces of the conversations rebuilt: the first h turns of conversation c - c % group, then c's own after its first h.

    h = crc32(decimal c) % most; ``start`` and ``total`` count the rebuilt turns. Every conversation keeps a piece at 0.
    """
    base = (F.col("conv_id") - F.col("conv_id") % group).alias("base")
    first = found.where((F.col("start") < most - 1) & (F.col("conv_id") % group == 0)).select(
        F.col("conv_id").alias("base"), "start", F.substring("digs", 1, 16 * (most - 1)).alias("digs"), F.substring("words", 1, 8 * (most - 1)).alias("words"))
    joined = lambda c: F.aggregate("parts", F.unhex(F.lit("")), lambda acc, x: F.concat(acc, x[c]))
    heads = (first.groupBy("base").agg(F.array_sort(F.collect_list(F.struct("start", "digs", "words"))).alias("parts"))
             .select("base", joined("digs").alias("head_digs"), joined("words").alias("head_words")))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    with_h = found.select("*", base, h.alias("h")).join(heads, "base", "left").withColumn(
        "nb", F.least(F.col("h"), F.coalesce(F.octet_length("head_digs") / 16, F.lit(0)).cast("long")))
    cut = F.greatest(F.lit(0), F.least(F.col("n"), F.col("h") - F.col("start")))
    at_start = F.col("start") == 0
    glue = lambda head, own, width: F.concat(
        F.when(at_start, F.coalesce(F.substring(F.col(head), F.lit(1), (F.col("nb") * width).cast("int")), F.unhex(F.lit("")))).otherwise(F.unhex(F.lit(""))),
        F.substring(F.col(own), (cut * width + 1).cast("int"), ((F.col("n") - cut) * width).cast("int")))
    return with_h.select(
        "conv_id", "part",
        F.when(at_start, F.lit(0).cast("long")).otherwise(F.col("nb") + F.greatest(F.col("start"), F.col("h")) - F.col("h")).alias("start"),
        (F.col("nb") + F.greatest(F.lit(0), F.col("total") - F.col("h"))).alias("total"),
        glue("head_digs", "digs", 16).alias("digs"), glue("head_words", "words", 8).alias("words")).where(
        (F.col("start") == 0) | (F.octet_length("digs") > 0))


def _alone_from(long_: DataFrame) -> DataFrame:
    """conv_id, alone_at: of long conversations those of whom no other shares the first ``alone_at`` turns."""
    def run(batches):
        schema = pa.schema([("conv_id", pa.int64()), ("level", pa.int64()), ("print", pa.int64())])
        for b in batches:
            out = []
            for conv, start, total, digs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                x = np.frombuffer(digs, "<u8").reshape(-1, 2)
                at = np.arange(start, start + len(x), dtype=np.uint64)
                x = x[:, 0] ^ x[:, 1] * np.uint64(0x9E3779B97F4A7C15) ^ (at + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
                x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
                x ^= x >> np.uint64(29)
                level = 2 * SEGMENT
                while level < total:
                    if start < level:
                        out.append((conv, level, int(np.bitwise_xor.reduce(x[:level - start]).astype(np.int64))))
                    level *= 4
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], schema=schema)

    prints = (long_.select("conv_id", "start", "total", "digs").mapInArrow(run, "conv_id long, level long, print long")
              .groupBy("conv_id", "level").agg(F.bit_xor("print").alias("print")))
    one = prints.groupBy("level", "print").agg(F.count(F.lit(1)).alias("c"), F.min("conv_id").alias("conv_id")).where("c = 1")
    return one.groupBy("conv_id").agg(F.min("level").alias("alone_at"))


def sequences(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, digs, words, more) of what conversations may share, and the pieces (conv_id, start, n, total) beyond that."""
    bounded_batches(parts.sparkSession, 1024)
    long_ = parts.where(F.octet_length("digs") / 16 < F.col("total"))
    cut = store(long_.join(_alone_from(long_), "conv_id", "left").withColumn(
        "inside", (F.col("start") == 0) | F.col("alone_at").isNull() | (F.col("start") < F.col("alone_at"))), "trie-long")
    joined = lambda c: F.aggregate("parts", F.unhex(F.lit("")), lambda acc, x: F.concat(acc, x[c]))
    inner = (cut.where("inside").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("start", "part", "digs", "words"))).alias("parts"), F.max("total").alias("total"))
             .select("conv_id", joined("digs").alias("digs"), joined("words").alias("words"), "total"))
    shared = (parts.where(F.octet_length("digs") / 16 >= F.col("total")).select("conv_id", "digs", "words", F.lit(False).alias("more"))
              .unionByName(inner.select("conv_id", "digs", "words", (F.octet_length("digs") / 16 < F.col("total")).alias("more"))))
    rest = cut.where("NOT inside").select("conv_id", "start", (F.octet_length("digs") / 16).cast("long").alias("n"), "total")
    return shared, rest


def median_order(n: int) -> list[int]:
    """0 .. n-1 with the middle first, then the middles of the halves, and so on."""
    out, todo = [], [(0, n)]
    for lo, hi in todo:
        if lo < hi:
            mid = (lo + hi) // 2
            out.append(mid)
            todo += ((lo, mid), (mid + 1, hi))
    return out


class Tree:
    """Ternary search tree: ``low`` and ``high`` lead to siblings of smaller and larger code, ``below`` to the children."""

    def __init__(self):
        self.code, self.low, self.high, self.below, self.parent, self.depth, self.words = [-1], [-1], [-1], [-1], [-1], [0], [0]

    def _new(self, code: int, parent: int, words: int) -> int:
        for column, value in ((self.code, code), (self.low, -1), (self.high, -1), (self.below, -1), (self.parent, parent),
                              (self.depth, self.depth[parent] + 1), (self.words, words)):
            column.append(value)
        return len(self.code) - 1

    def insert(self, codes: list[int], words: list[int]) -> list[int]:
        """The path of nodes of a sequence, the root first; new nodes come behind their parents."""
        at, path = 0, [0]
        code_of, low, high, below = self.code, self.low, self.high, self.below
        for code, w in zip(codes, words, strict=True):
            x, links, k = below[at], below, at
            while x >= 0 and code_of[x] != code:
                links, k = (low, x) if code < code_of[x] else (high, x)
                x = links[k]
            if x < 0:
                x = links[k] = self._new(code, at, w)
            at = x
            path.append(x)
        return path


SHARD_SCHEMA = [("done", "boolean", pa.bool_()), ("shard", "long", pa.int64()), ("key", "binary", pa.binary()), ("parent_key", "binary", pa.binary()),
                *((c, "long", pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "words", "n_convs", "n_children", "n_leaves", "saved_tokens")),
                ("more", "boolean", pa.bool_()), ("ends", "string", pa.string()), ("ends_sha256", "string", pa.string())]


def shard_nodes(rows: list[tuple], shard: int) -> list[tuple]:
    """Nodes of sorted sequences (conv_id, digs, words, more), as SHARD_SCHEMA: finished ones, and those other shards may hold."""
    distinct: list[tuple] = []
    for conv, digs, words, more in rows:
        if distinct and distinct[-1][0] == digs:
            distinct[-1][3].append(conv)
        else:
            distinct.append((digs, words, more, [conv]))
    turns = [[digs[k:k + 16] for k in range(0, len(digs), 16)] for digs, *_ in distinct]
    codes = {d: k for k, d in enumerate(sorted(set().union(*turns)))}
    tree, paths = Tree(), {}
    members: dict[int, list[int]] = {}
    unfinished: set[int] = set()
    for k in median_order(len(distinct)):
        path = tree.insert([codes[d] for d in turns[k]], np.frombuffer(distinct[k][1], "<i8").tolist())
        if k in (0, len(distinct) - 1):
            paths[k] = path
        members[path[-1]] = distinct[k][3]
        if distinct[k][2]:
            unfinished.add(path[-1])
    keys = {0: ROOT}
    for k in (0, len(distinct) - 1):
        for x, d in zip(paths[k][1:], turns[k], strict=True):
            if x not in keys:
                keys[x] = hashlib.sha256(keys[tree.parent[x]] + d).digest()[:16]

    n = len(tree.code)
    convs, least, children, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    for x, ids in members.items():
        convs[x], least[x] = len(ids), ids[0]
    for x in range(n - 1, 0, -1):  # children come after their parents
        up = tree.parent[x]
        convs[up] += convs[x]
        least[up] = least[x] if least[up] is None else min(least[up], least[x])
        if x not in keys:
            leaves[x] += not children[x]
            saved[x] += (convs[x] - 1) * tree.words[x]
            children[up] += 1
            leaves[up] += leaves[x]
            saved[up] += saved[x]
    out = []
    for x in range(n):
        up, ends = tree.parent[x], "" if x in unfinished else ",".join(map(str, members.get(x, ())))
        if x in keys:
            out.append((False, shard, keys[x], keys.get(up), least[x], tree.depth[x], None, tree.words[x], convs[x], children[x], leaves[x], saved[x],
                        x in unfinished, ends or None, None))
        else:
            out.append((True, shard, None, keys.get(up), least[x], tree.depth[x], None if up in keys else least[up], tree.words[x], convs[x],
                        children[x] + (x in unfinished), leaves[x], saved[x], False, None, hashlib.sha256(ends.encode()).hexdigest() if ends else EMPTY))
    return out


def _sharded(shared: DataFrame) -> DataFrame:
    """``shard_nodes`` of every range shard of the sorted sequences, at most SHARD_TURNS turns (or rows) each."""
    schema = pa.schema([(c, t) for c, _, t in SHARD_SCHEMA])

    def run(batches):
        from pyspark import TaskContext

        shard, held, size = TaskContext.get().partitionId() << 33, [], 0

        def out():
            rows = shard_nodes(held, shard)
            for at in range(0, len(rows), 1 << 14):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at:at + (1 << 14)], strict=True), schema.types, strict=True)], schema=schema)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(row)
                size += 1 + (len(row[1]) >> 4)
                if size >= SHARD_TURNS:
                    yield from out()
                    held, size, shard = [], 0, shard + 1
        if held:
            yield from out()

    bounded_batches(shared.sparkSession, 1024)
    sorted_ = shared.repartitionByRange("digs", "conv_id").sortWithinPartitions("digs", "conv_id")
    return store(sorted_.mapInArrow(run, ", ".join(f"{c} {t}" for c, t, _ in SHARD_SCHEMA)), "trie-shards")


def _hashed_ends(found: DataFrame) -> DataFrame:
    """key, ends_sha256 of merged nodes: their shards' texts of ids, in order, hashed as a stream."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches):
        key, state = None, None
        for b in batches:
            done = []
            for k, ends in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], schema=schema)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], schema=schema)

    bounded_batches(found.sparkSession, 16)
    texts = found.where("ends IS NOT NULL").select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
    return store(texts.select("key", "ends").mapInArrow(run, "key binary, ends_sha256 string"), "trie-ends")


def _merged(found: DataFrame) -> DataFrame:
    """Nodes that several shards may hold: figures summed by path, then over subtrees."""
    nodes = found.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("words").alias("words"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("more").alias("more"))
    nodes = store(nodes, "trie-merged")
    below = nodes.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("b"))
    children = F.col("n_children") + F.coalesce("b", F.lit(0))
    sums = store(nodes.join(below, "key", "left").select(
        "key", F.col("parent_key").alias("up"), (F.col("n_leaves") + F.when(children == 0, 1).otherwise(0)).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        (children + F.col("more").cast("long")).alias("n_children")), "trie-sums")
    for _ in range((nodes.agg(F.max("depth")).first()[0] or 0).bit_length()):
        added = sums.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        further = sums.select(F.col("key").alias("up"), F.col("up").alias("next"))
        grown = store(sums.join(added, "key", "left").join(further, "up", "left").select(
            "key", F.col("next").alias("up"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens"), "n_children"), "trie-sums")
        discard(sums)
        sums = grown
    over = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    ends = _hashed_ends(found)
    out = store(nodes.drop("n_children", "n_leaves", "saved_tokens").join(sums.drop("up"), "key").join(over, "parent_key", "left").join(ends, "key", "left")
                .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))), "trie-open")
    discard(nodes, sums, ends)
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_of(parts: DataFrame) -> DataFrame:
    """The nodes (COLUMNS) of conversations given as stored pieces (conv_id, part, start, total, digs, words)."""
    shared, rest = sequences(parts)
    shared, rest = store(shared, "trie-sequences"), store(rest, "trie-rest")
    found = _sharded(shared)
    open_ = _merged(found.where("NOT done"))
    over = open_.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("known"))
    done = found.where("done").join(over, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("known", "parent_conv_id"))
    chain = rest.select("conv_id", "total", F.explode(F.sequence(F.col("start") + 1, F.col("start") + F.col("n"))).alias("depth")).select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        (F.col("depth") < F.col("total")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("depth") == F.col("total"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(EMPTY).alias("ends_sha256"))
    out = store(done.select(*COLUMNS).unionByName(open_.select(*COLUMNS)).unionByName(chain), "trie-nodes")
    discard(shared, rest, found, open_)
    return out


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes (COLUMNS) of the conversations as they are."""
    turns = store(turn_digests(conversations), "trie-turns")
    parts = store(pieces(turns), "trie-parts")
    out = trie_of(parts)
    discard(turns, parts)
    return out


def q_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the conversations rebuilt with shared heads (``share_heads``)."""
    turns = store(turn_digests(table(spark, sf_dir, "conversations")), "trie-turns")
    parts = store(share_heads(pieces(turns)), "trie-parts")
    out = trie_of(parts)
    discard(turns, parts)
    return out


#: CRC-32 in SQL: a list of byte and shift steps reduced from the initial value
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
  lambda c: [256 + ascii(c), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]))),
  lambda r, x: CASE WHEN x > 0 THEN xor(r, x - 256) WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END))"""

Q_SQL = rf"""
WITH t AS (
  SELECT conv_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words, said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS p
  FROM (SELECT *, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT DISTINCT conv_id, {CRC} % 4 AS h FROM t),
r AS (SELECT c.conv_id, p, said, words FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND p <= h
      UNION ALL SELECT c.conv_id, p, said, words FROM c JOIN t ON t.conv_id = c.conv_id AND p > h),
s AS (SELECT conv_id, list(said ORDER BY p) AS seq, list(words ORDER BY p) AS ws FROM r GROUP BY conv_id),
a AS (SELECT c.conv_id, coalesce(seq, []) AS seq, coalesce(ws, []) AS ws FROM c LEFT JOIN s ON s.conv_id = c.conv_id),
m AS (SELECT conv_id, seq, ws, unnest(range(0, len(seq) + 1)) AS depth FROM a),
n AS (SELECT seq[1:depth] AS pre, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(max(ws[depth]), 0) AS words,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(seq) = depth), '')) AS ends_sha256
      FROM m GROUP BY pre, depth),
k AS (SELECT pre[1:depth - 1] AS pre, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.pre = n.pre),
u AS (SELECT up.pre[1:up.d] AS pre, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
      FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM f) up GROUP BY 1)
SELECT f.conv_id, f.depth::BIGINT AS depth, b.conv_id AS parent_conv_id, f.n_convs, f.n_children, u.n_leaves::BIGINT AS n_leaves,
       u.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN u ON u.pre = f.pre LEFT JOIN f b ON f.depth > 0 AND b.pre = f.pre[1:f.depth - 1]
"""
