"""Upsert (REPLACE) and hierarchy synchronisation as snapshot transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import remap
from ..operators.hierarchy import DIFF_COLUMNS, merge_hierarchy
from ..operators.joins import sized_broadcast
from .partitioned import hashable, without_key


def upsert(target: DataFrame | None, source: DataFrame, keys: list[str], newest: str = "last_updated_time") -> DataFrame:
    """The new snapshot: source rows replace target rows of the same key as a whole (unset
    source fields become NULL); target rows without a source row stay.

    One rule on every run, the first (``target`` None) included: of the rows of a key the source's win over the
    target's, then the largest ``newest`` if there is such a column, then the largest row hash, so a retry decides
    alike. Rows with a NULL in the key match nothing but an equal row, so repeating a run adds none. Both sides
    are tagged and meet in one shuffle on the keys; the source is evaluated once and no side is broadcast.
    """
    tagged = source.withColumn("__side", F.lit(1))
    if target is not None:
        tagged = target.withColumn("__side", F.lit(0)).unionByName(tagged, allowMissingColumns=True)
    cols = [c for c in tagged.columns if c != "__side"]
    tie = F.xxhash64(*[hashable(tagged, c) for c in cols])
    order = F.struct("__side", *([newest] if newest in cols else []), tie)
    return (tagged.groupBy(*[F.col(k).alias(f"__{k}") for k in keys], without_key(tagged, keys, cols).alias("__no_key"))
            .agg(F.max_by(F.struct(*cols), order).alias("row")).select("row.*"))


def hierarchy_sync(prepared: DataFrame, target: DataFrame, run_ms: int, counters: Observation | None = None) -> DataFrame:
    """B6 applied: the target asset table after making every in-scope root
    equal to the source (create, update, delete).

    ``prepared`` is the output of ``replicate.prepare_assets`` (with
    ``root_external_id``). Source and target meet in one join (``merge_hierarchy``). New assets get
    ``id = xxhash64(external_id)``; parent and root ids are resolved through the new table's external ids.
    ``counters`` observes the assets by op and the duplicates of either side.
    """
    prepared = prepared.checkpoint()  # its roots are the scope, its rows one side of the join
    tgt = remap.parent_and_root_ext(target.drop("parent_external_id"), remap.id_to_ext(target))
    fields = ["external_id", *DIFF_COLUMNS, "root_external_id"]
    merged = merge_hierarchy(prepared.select(*fields), tgt.select("id", *fields, "created_time", "last_updated_time"))
    if counters is not None:
        merged = merged.observe(counters, *[F.count_if(F.col("op") == o).alias(o) for o in ("create", "update", "delete", "unchanged", "outside")],
                                *[F.coalesce(F.sum(F.col(f"{k}_n") - 1), F.lit(0)).alias(f"{name}_duplicates") for k, name in (("s", "source"), ("t", "target"))])
    outside, unchanged = F.col("op") == "outside", F.col("op").isin("outside", "unchanged")
    side = lambda c: F.when(outside, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
    new = (merged.where("op <> 'delete'")
           .select(F.coalesce("t.id", F.xxhash64("external_id")).alias("id"), "external_id", *[side(c) for c in (*DIFF_COLUMNS, "root_external_id")],
                   F.coalesce("t.created_time", F.when(~outside, F.lit(run_ms))).alias("created_time"),
                   F.when(unchanged, F.col("t.last_updated_time")).otherwise(F.lit(run_ms)).alias("last_updated_time"))
           .checkpoint())  # read by three branches below
    ids = new.where("external_id IS NOT NULL").select(F.col("external_id").alias("__ext"), F.col("id").alias("__id"))
    par = ids.select(F.col("__ext").alias("__pext"), F.col("__id").alias("parent_id"))
    # root external ids are hot keys: resolve them through the (small) set of roots
    roots = new.select(F.col("root_external_id").alias("__ext")).distinct()
    root = sized_broadcast(ids.join(roots, "__ext", "left_semi")
                           .select(F.col("__ext").alias("__rext"), F.col("__id").alias("root_id")))
    return (new.join(par, F.col("parent_external_id") == F.col("__pext"), "left")
            .join(root, F.col("root_external_id") == F.col("__rext"), "left")
            .drop("__pext", "__rext"))
