"""Asset hierarchy operators: path / depth / child count (A1a) and the
hierarchy diff used by hierarchy synchronisation (B6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import sized_broadcast


def path_depth_children(assets: DataFrame) -> DataFrame:
    """(id, depth, path, child_count) for every asset.

    Pointer doubling: every asset holds the path up to some ancestor and joins
    that ancestor's, so the known part doubles each round and a tree of any depth
    takes log2(depth) rounds. Each round is checkpointed to the shared checkpoint
    folder, which cuts the lineage. Assets that no root reaches (orphan parents,
    cycles) get NULL depth and path: a missing ancestor finds no row to join, and
    a path that meets its own ancestor again is dropped.
    """
    # one row an id (the largest parent, as in the lookup maps), so ids given twice don't multiply
    edges = assets.filter(F.col("id").isNotNull()).groupBy("id").agg(F.max("parent_id").alias("parent_id"))
    # top: the next ancestor whose path is still to be put in front; NULL once the root is reached
    walk = edges.select("id", F.col("parent_id").alias("top"), F.array("id").alias("path")).checkpoint()
    while not walk.filter(F.col("top").isNotNull()).isEmpty():
        done, open_ = walk.filter(F.col("top").isNull()), walk.filter(F.col("top").isNotNull())
        ahead = walk.select(F.col("id").alias("__id"), F.col("top").alias("__top"), F.col("path").alias("__path"))
        walk = done.unionByName(
            open_.join(ahead, F.col("top") == F.col("__id"))
            .filter(~F.arrays_overlap("path", "__path"))
            .select("id", F.col("__top").alias("top"), F.concat("__path", "path").alias("path"))).checkpoint()
    placed = walk.select("id", (F.size("path") - 1).cast("long").alias("depth"), "path")
    children = (edges.filter(F.col("parent_id").isNotNull())
                .groupBy(F.col("parent_id").alias("id")).agg(F.count(F.lit(1)).alias("child_count")))
    return (edges.select("id")
            .join(placed, "id", "left")
            .join(children, "id", "left")
            .select("id", "depth", "path",
                    F.coalesce("child_count", F.lit(0)).cast("long").alias("child_count")))


# Columns compared by the hierarchy diff (everything a replicated asset carries).
DIFF_COLUMNS = ("name", "parent_external_id", "description", "source", "data_set_id", "labels", "metadata")


def _comparable(c: str):
    if c == "metadata":
        return F.array_sort(F.map_entries(F.col(c)))
    return F.col(c)


def _one_a_key(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    """external_id, one row of it as a struct (the newest, then the largest row hash), the number of rows it had."""
    newest = ["last_updated_time"] if "last_updated_time" in cols else []
    order = F.struct(*newest, F.xxhash64("external_id", *[_comparable(c) for c in cols]))
    return df.groupBy("external_id").agg(F.max_by(F.struct(*cols, F.struct(*[_comparable(c).alias(c) for c in DIFF_COLUMNS]).alias("compared")), order).alias(name),
                                         F.count(F.lit(1)).alias(f"{name}_n"))


def merge_hierarchy(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source and target assets met once by external id: external_id, s, t (both rows whole), s_n, t_n, op.

    ``source`` holds the replicated source assets, ``target`` the target's, both with ``root_external_id``. Assets match
    across the whole target (one may move between roots). op is create, update, unchanged, delete (a target asset
    under a root of the source, which the source lacks) or outside (any other target asset). One full outer join; both
    sides are reduced to one row a key in the same partitioning, so duplicates (s_n, t_n) can't multiply. Target
    assets without external id match nothing and pass by the join.
    """
    s_cols = [c for c in source.columns if c != "external_id"]
    t_cols = [c for c in target.columns if c != "external_id"]
    s = _one_a_key(source.where("external_id IS NOT NULL"), s_cols, "s")
    t = _one_a_key(target.where("external_id IS NOT NULL"), t_cols, "t")
    both = s.join(t, "external_id", "full_outer")
    lone = target.where("external_id IS NULL").select("external_id", F.struct(
        *t_cols, F.struct(*[_comparable(c).alias(c) for c in DIFF_COLUMNS]).alias("compared")).alias("t"), F.lit(1).cast("long").alias("t_n"))
    scope = source.select(F.col("root_external_id").alias("__root"), F.lit(True).alias("__in")).distinct()
    met = both.unionByName(lone, allowMissingColumns=True).join(sized_broadcast(scope), F.col("t.root_external_id") == F.col("__root"), "left")
    same = F.col("s.compared").eqNullSafe(F.col("t.compared")) & F.col("s.root_external_id").eqNullSafe(F.col("t.root_external_id"))
    op = (F.when(F.col("t").isNull(), "create").when(F.col("s").isNull(), F.when(F.col("__in"), "delete").otherwise("outside"))
          .when(same, "unchanged").otherwise("update"))
    return met.select("external_id", "s", "t", "s_n", "t_n", op.alias("op"))


def hierarchy_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """B6 plan: per asset in scope (external_id, root_external_id, op), op in {create, update, delete, unchanged}."""
    cols = ["external_id", *DIFF_COLUMNS, "root_external_id"]
    return merge_hierarchy(source.select(*cols), target.select(*cols)).where("op <> 'outside'").select(
        "external_id", F.coalesce("s.root_external_id", "t.root_external_id").alias("root_external_id"), "op")
