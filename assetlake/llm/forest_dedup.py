"""Embedding near-dedup with a random-projection tree forest.

Equal vectors of a label are one class. Every tree splits its nodes recursively:
a node's rows are projected on the node's own random direction (a function of
seed, tree and node alone) and split at the median; rows within ``SPILL`` of it
go to both sides. A node is a leaf once it holds at most ``LEAF`` rows or when a
split no longer separates its rows. Levels run as Spark jobs (medians are partial
aggregates), so no node is gathered anywhere.

Rows are compared within leaves in double precision, in cells of ``CELL`` x
``CELL`` rows, so a leaf that can't be split is still compared in full and over
many tasks. A pair that shares several leaves is counted in the one with the
smallest code only. A cell returns one row per linked member (how many vectors it
links with, a member of its component), never the pairs.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite
components, or have a NULL label, link with nothing, and so do rows with a NULL
vec_id (component NULL, kept). Vectors of different lengths don't compare. A
vec_id that repeats with equal vectors counts as that many vectors. An empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.common import bounded_batches, components, store, table, unclash

THRESHOLD = 0.98
TREES = 4
LEAF = 256
SPILL = 0.03  # of unit vectors' projections: at cosine 0.98 and 64 dimensions two rows lie 0.025 apart (one sigma)
CELL = 256
MAX_LEVELS = 60
SEED = 11


def direction(tree: int, node: int, dims: int) -> np.ndarray:
    v = np.random.default_rng([SEED, tree, node & 0xFFFFFFFF, (node >> 32) & 0xFFFFFFFF, dims]).standard_normal(dims)
    return v / np.linalg.norm(v)


def _unit(column: pa.Array) -> list[np.ndarray]:
    out = []
    for x in column:
        v = np.array(x.values, np.float64)
        out.append(v / np.linalg.norm(v))
    return out


def _project(rows: DataFrame) -> DataFrame:
    """Adds ``proj``, the position of the unit vector on its node's direction."""
    schema = pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("cls", pa.int64()), ("proj", pa.float64())])

    def run(batches):
        known: dict = {}
        for b in batches:
            out = []
            for t, n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _unit(b.column(3)), strict=True):
                d = known.get((t, n, len(x)))
                if d is None:
                    if len(known) > 10_000:
                        known.clear()
                    d = known[t, n, len(x)] = direction(t, n, len(x))
                out.append(float(d @ x))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.float64())], schema=schema)

    return rows.select("tree", "node", "cls", "vec").mapInArrow(run, "tree int, node long, cls long, proj double")


def forest(classes: DataFrame, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """(tree, node, cls, m): leaf membership of every class, m being the leaf's size."""
    root = F.pmod(F.xxhash64("label", F.size("vec")), F.lit(1 << 40))
    rows = store(classes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
                 .select("tree", root.alias("node"), "cls"), "forest-root")
    done = []
    for _ in range(MAX_LEVELS):
        sizes = store(rows.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("m")), "forest-sizes")
        sized = rows.join(sizes, ["tree", "node"])
        done.append(sized.where(F.col("m") <= leaf))
        big = sized.where(F.col("m") > leaf).join(classes.select("cls", "vec"), "cls")
        proj = store(_project(big), "forest-projected")
        cut = store(proj.groupBy("tree", "node").agg(F.percentile_approx("proj", 0.5, 1000).alias("cut"),
                                                     F.count(F.lit(1)).alias("m")), "forest-cuts")
        sides = (proj.join(cut, ["tree", "node"]).withColumn("low", F.col("proj") <= F.col("cut") + SPILL)
                 .withColumn("high", F.col("proj") >= F.col("cut") - SPILL))
        sides = store(sides.drop("proj", "cut"), "forest-sides")
        grown = store(sides.groupBy("tree", "node").agg(F.sum(F.col("low").cast("long")).alias("nl"),
                                                        F.sum(F.col("high").cast("long")).alias("nh")), "forest-grown")
        # a split that leaves nine tenths on one side separates nothing: its rows are near each other
        stuck = F.greatest("nl", "nh") > F.lit(0.9) * F.col("m")
        split = store(sides.join(grown, ["tree", "node"]).withColumn("stuck", stuck), "forest-split")
        done.append(split.where("stuck").select("tree", "node", "cls", "m"))
        child = F.explode(F.filter(F.array(F.when(F.col("low"), F.lit(0)), F.when(F.col("high"), F.lit(1))), lambda x: x.isNotNull()))
        rows = store(split.where("not stuck").withColumn("side", child)
                     .select("tree", F.xxhash64("node", "side").alias("node"), "cls"), "forest-rows")
        if rows.isEmpty():
            break
    else:
        sizes = store(rows.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("m")), "forest-sizes")
        done.append(rows.join(sizes, ["tree", "node"]))  # compared in cells like any leaf
    out = done[0].select("tree", "node", "cls", "m")
    for d in done[1:]:
        out = out.unionByName(d.select("tree", "node", "cls", "m"))
    return store(out, "forest-leaves")


def compare(leaves: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, links, root): per cell and linked member, how many vectors it links with and a member of its component."""
    code = F.xxhash64("tree", "node")
    coded = leaves.withColumn("code", code)
    member = store(coded.groupBy("cls").agg(F.sort_array(F.collect_set("code")).alias("codes")), "forest-codes")
    nb = F.ceil(F.col("m") / F.lit(CELL)).cast("long")
    rows = (coded.join(member, "cls").join(classes.select("cls", "vec", "copies"), "cls")
            .withColumn("nb", nb).withColumn("blk", F.pmod(F.xxhash64("cls"), F.col("nb")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
            .select("code", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "cls", "codes", "vec", "copies"))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        here, same = g["code"].iat[0], g["i"].iat[0] == g["j"].iat[0]
        x = np.array([np.array(v, np.float64) for v in g["vec"]])
        x /= np.linalg.norm(x, axis=1)[:, None]
        left = np.arange(len(g)) if same else np.flatnonzero((g["blk"] == g["i"]).to_numpy())
        right = np.arange(len(g)) if same else np.flatnonzero((g["blk"] == g["j"]).to_numpy())
        cos = x[left] @ x[right].T
        cls, copies = g["cls"].to_numpy(), g["copies"].to_numpy()
        codes = [set(c) for c in g["codes"]]
        links, root = np.zeros(len(g), np.int64), np.arange(len(g))

        def top(k):
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for p, q in zip(*np.nonzero(cos >= THRESHOLD - 1e-9), strict=True):
            p, q = left[p], right[q]
            if (same and p >= q) or cls[p] == cls[q] or float(np.dot(x[p], x[q])) < THRESHOLD:
                continue
            if min(codes[p] & codes[q]) != here:
                continue  # this pair is counted in another leaf
            links[p] += copies[q]
            links[q] += copies[p]
            root[top(p)] = top(q)
        k = np.flatnonzero(links)
        return pd.DataFrame({"cls": cls[k], "links": links[k], "root": [cls[top(i)] for i in k]})

    return rows.groupBy("code", "i", "j").applyInPandas(run, "cls long, links long, root long")


def near_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    bounded_batches(vectors.sparkSession, 2048)
    v = unclash(vectors, ["vec_id", "embedding", "label"])
    fine = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists("embedding", lambda x: x != 0))
    usable = v.where(F.coalesce(fine, F.lit(False)))
    # -0.0 and 0.0 are one value
    clean = F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double")))
    narrow = store(usable.select("vec_id", "label", clean.alias("vec")), "forest-vectors")
    classes = store(narrow.groupBy("label", "vec").agg(F.min("vec_id").alias("cls"), F.count(F.lit(1)).alias("copies")), "forest-classes")
    # an id that repeats with other vectors would name two classes; those get ids of their own
    twice = classes.groupBy("cls").agg(F.count(F.lit(1)).alias("k")).where("k > 1").limit(1).count()
    if twice:
        classes = store(classes.withColumn("smallest", F.col("cls")).withColumn("cls", F.xxhash64("label", "vec")), "forest-classes")
    else:
        classes = classes.withColumn("smallest", F.col("cls"))
    found = store(compare(forest(classes), classes), "forest-found")
    links = store(found.groupBy("cls").agg(F.sum("links").alias("links")), "forest-links")
    comp = components(found.select(F.col("cls").alias("src"), F.col("root").alias("dst")), "forest-cc")
    named = (classes.join(links, "cls", "left").join(comp.withColumnRenamed("node", "cls"), "cls", "left")
             .select("label", "vec", "cls", "smallest", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component_id", "cls").alias("comp")))
    named = store(named, "forest-named")
    least = named.groupBy("comp").agg(F.min("smallest").alias("component_id"))
    decided = store(named.join(least, "comp").select(F.col("label").alias("l"), F.col("vec").alias("w"), "copies", "links", "component_id"), "forest-decided")
    linked = narrow.join(decided, (F.col("label") == F.col("l")) & (F.col("vec") == F.col("w"))).select(
        "vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    alone = v.where(~F.coalesce(fine, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def q_forest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
