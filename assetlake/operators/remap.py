"""Foreign-key translation between tenants (source id -> external id -> target id).

The reference resolves each link with two in-memory map lookups per record.
Here the two lookup maps are pre-joined into one *translation* dimension
``(src_id, tgt_id)`` and applied with a single join; the dimension is
broadcast only when a size check allows it, otherwise the join shuffles on
the key and AQE splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import non_blank
from .joins import salted_join, sized_broadcast, sized_dim


def id_to_ext(df: DataFrame, id_col: str = "id", ext_col: str = "external_id") -> DataFrame:
    """Source map id -> external id; blanks dropped, max per key."""
    return (df.filter(F.col(id_col).isNotNull() & non_blank(ext_col))
            .groupBy(F.col(id_col).alias("src_id"))
            .agg(F.max(ext_col).alias("external_id")))


def ext_to_id(df: DataFrame, id_col: str = "id", ext_col: str = "external_id") -> DataFrame:
    """Target map external id -> id; blanks dropped, max per key."""
    return (df.filter(F.col(id_col).isNotNull() & non_blank(ext_col))
            .groupBy(F.col(ext_col).alias("external_id"))
            .agg(F.max(id_col).alias("tgt_id")))


def translation(source: DataFrame, target: DataFrame) -> DataFrame:
    """Pre-joined two-hop map ``(src_id, tgt_id)``.

    A source id with an external id goes through it. A source id without one
    is looked up at the target by its decimal text (the reference's
    ``getOrDefault(id, String.valueOf(id))``), which is the same as reading
    target external ids that are canonical decimal numbers, for ids absent
    from the source map.
    """
    src = id_to_ext(source)
    tgt = ext_to_id(target)
    via_ext = src.join(tgt, "external_id").select("src_id", "tgt_id")
    as_num = F.col("external_id").try_cast("bigint")
    by_text = (tgt.filter(as_num.isNotNull() & (as_num.cast("string") == F.col("external_id")))
               .select(as_num.alias("src_id"), "tgt_id")
               .join(src.select("src_id"), "src_id", "left_anti"))
    return via_ext.unionByName(by_text)


def remap_scalar(df: DataFrame, column: str, trans: DataFrame, out: str | None = None) -> DataFrame:
    """Replace ``column`` by its target id, NULL when it has none."""
    out = out or column
    t = sized_broadcast(trans.select(F.col("src_id").alias("__k"), F.col("tgt_id").alias("__v")))
    return (df.join(t, F.col(column) == F.col("__k"), "left")
            .withColumn(out, F.col("__v")).drop("__k", "__v"))


def map_array(df: DataFrame, key: str, column: str, mapping: DataFrame, salts: int = 1) -> DataFrame:
    """Map every element of an array through ``mapping(k, v)``.

    Unmapped elements are dropped; order and duplicates are kept; rows with
    empty or NULL arrays survive with an empty array. Each distinct array is
    mapped once and joined back by its value, so ids may repeat or be NULL (``key`` names
    the row id and isn't read) and only the arrays go through the grouping, which never
    gathers more than one array's elements. When the mapping is too large to
    broadcast, ``salts`` > 1 spreads a hot element (one asset linked from a
    large share of the rows) over that many tasks.
    """
    m, small = sized_dim(mapping.select(F.col("k").alias("__e"), F.col("v").alias("__v")))
    arrays = df.select(F.col(column).alias("__key")).where(F.size("__key") > 0).distinct()
    elems = arrays.select("__key", F.posexplode("__key").alias("__pos", "__e"))
    if salts > 1 and not small:
        joined = salted_join(elems, m.withColumnRenamed("__e", "__e2"), "__e", "__e2", salts).drop("__e2")
    else:
        joined = elems.join(m, "__e")
    mapped = (joined
              .groupBy("__key")
              .agg(F.array_sort(F.collect_list(F.struct("__pos", "__v"))).alias("__m")))
    elem_type = mapping.schema["v"].dataType.simpleString()
    return (df.join(mapped, F.col(column) == F.col("__key"), "left")
            .withColumn(column, F.coalesce(F.transform("__m", lambda x: x["__v"]),
                                           F.array().cast(f"array<{elem_type}>")))
            .drop("__key", "__m"))


def remap_array(df: DataFrame, key: str, column: str, trans: DataFrame, salts: int = 1) -> DataFrame:
    """E5: array of source ids -> array of target ids."""
    return map_array(df, key, column, trans.select(F.col("src_id").alias("k"), F.col("tgt_id").alias("v")), salts)


def keep_known(df: DataFrame, key: str, column: str, known: DataFrame, known_col: str = "external_id") -> DataFrame:
    """Keep only array values that exist in ``known`` (order kept, no dedup)."""
    vals = known.select(F.col(known_col).alias("k")).filter(F.col("k").isNotNull()).distinct()
    return map_array(df, key, column, vals.select("k", F.col("k").alias("v")))


def parent_and_root_ext(assets: DataFrame, id_map: DataFrame) -> DataFrame:
    """Parent id -> parent external id (no match => root asset, NULL),
    root id -> root external id as the group key ("" when unknown).

    ``root_id`` is a hot key by nature (one root may own a large share of all
    assets), so the root lookup uses only the map rows of ids that are roots:
    a small dimension that the size check broadcasts, so no skewed shuffle
    partition forms. The parent lookup is a plain left join (broadcast when
    the planner's size estimate allows; AQE splits a hot parent otherwise).
    """
    par = id_map.select(F.col("src_id").alias("__pid"), F.col("external_id").alias("__pext"))
    root_ids = assets.select(F.col("root_id").alias("src_id")).filter(F.col("src_id").isNotNull()).distinct()
    root = sized_broadcast(id_map.join(root_ids, "src_id", "left_semi")
                           .select(F.col("src_id").alias("__rid"), F.col("external_id").alias("__rext")))
    return (assets
            .join(par, F.col("parent_id") == F.col("__pid"), "left")
            .join(root, F.col("root_id") == F.col("__rid"), "left")
            .withColumn("parent_external_id", F.col("__pext"))
            .withColumn("root_external_id", F.coalesce(F.col("__rext"), F.lit("")))
            .drop("__pid", "__pext", "__rid", "__rext"))
