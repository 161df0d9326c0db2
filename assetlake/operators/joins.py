"""Join helpers: broadcast only behind a size check, shuffle join otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# A dimension is broadcast only when its rows, as JSON, take at most this many
# bytes and it holds at most this many rows; beyond either the planner's shuffle
# (sort-merge) join is used, with AQE splitting skewed partitions.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
BROADCAST_MAX_ROWS = 2_000_000


def sized_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Materialize a dimension once, then broadcast it only if it is small;
    otherwise return it for a shuffle join.

    The dimension is written with ``checkpoint()`` to the shared checkpoint
    folder (``spark.checkpoint.dir``): it is computed exactly once, its size
    is observed by that job, the join reads the stored copy, and a lost
    executor does not force the dimension's lineage to be recomputed.
    """
    return sized_dim(df, max_rows)[0]


def sized_dim(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``sized_broadcast`` that also says whether the dimension is broadcast."""
    obs = Observation()
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    dim = df.observe(obs, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).checkpoint()
    seen = obs.get
    small = (seen["n"] <= (BROADCAST_MAX_ROWS if max_rows is None else max_rows)
             and seen["bytes"] <= (BROADCAST_MAX_BYTES if max_bytes is None else max_bytes))
    return (F.broadcast(dim) if small else dim), small


def list_frame(spark, values: list[str], name: str = "value") -> DataFrame:
    """A one-column frame from a (driver-side, config-sized) list of strings."""
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def salted_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, salts: int,
                how: str = "inner") -> DataFrame:
    """Equi-join that spreads hot fact keys over ``salts`` tasks.

    Each fact row gets a salt from a hash of the whole row; the dimension is
    replicated once per salt value, and the join runs on (key, salt). A key
    that holds a third of the fact rows is then handled by ``salts`` tasks
    instead of one. The dimension grows ``salts`` times, so use this for a
    dimension too large to broadcast but much smaller than the fact.
    """
    if salts <= 1:
        return fact.join(dim, fact[fact_key] == dim[dim_key], how)
    f = fact.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salts)))
    d = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return (f.join(d, (f[fact_key] == d[dim_key]) & (f["__salt"] == d["__salt"]), how)
            .drop(f["__salt"]).drop(d["__salt"]))
