"""run counters as a (counter, value) table, one global aggregate per job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.scalars import clean_file_name
from . import remap


def _counts(df: DataFrame, **conds) -> DataFrame:
    row = df.agg(*[F.count_if(c).cast("long").alias(k) for k, c in conds.items()])
    return row.select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(k) for k in conds]), F.array(*[F.col(k) for k in conds]))).alias("counter", "value"))


def run_counters(src, tgt, cfg: JobConfig) -> DataFrame:
    """Counters of the replicators: missing external ids, mapped / unmapped links,
    root assets, removed labels, cleaned file names. One global aggregate per
    resource (partial aggregation on every task, a tiny final merge)."""
    ev = src.events().select("id", "external_id", "asset_ids", "data_set_id")
    ev = remap.remap_array(ev, "id", "asset_ids", remap.translation(src.assets(), tgt.assets()))
    ev = remap.remap_scalar(ev, "data_set_id", remap.translation(src.data_sets(), tgt.data_sets()))
    assets = remap.parent_and_root_ext(src.assets(), remap.id_to_ext(src.assets()))
    files = src.files().select("id", "name", "labels")
    files = remap.keep_known(files.withColumn("kept", F.col("labels")), "id", "kept", tgt.labels())
    name = F.coalesce(F.col("name"), F.lit(""))
    parts = [
        _counts(ev, events_missing_external_id=F.col("external_id").isNull(),
                events_assets_mapped=F.size("asset_ids") > 0,
                events_data_set_mapped=F.col("data_set_id").isNotNull(),
                events_data_set_not_mapped=F.col("data_set_id").isNull()),
        _counts(assets, assets_root=F.col("parent_external_id").isNull()),
        _sums(files, files_forward_slash=name.contains("/").cast("long"),
              files_back_slash=name.contains("\\").cast("long"),
              files_cleaned=(clean_file_name(name) != name).cast("long"),
              files_labels_removed=(F.size("labels") - F.size("kept")).cast("long")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _sums(df: DataFrame, **exprs) -> DataFrame:
    row = df.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(k) for k, c in exprs.items()])
    return row.select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(k) for k in exprs]), F.array(*[F.col(k) for k in exprs]))).alias("counter", "value"))


def observed(seen: Observation) -> dict:
    """What ``seen`` observed in the action that ran; empty if the planner found a part of the plan without rows and
    never ran the observed one (``Observation.get`` fails then)."""
    return seen.get if seen._jo.getRow().length() else {}


class Counters:
    """counters of one run of a job, observed at several points of its plan while it writes; no job of their own."""

    def __init__(self, job: str):
        self.job, self._seen = job, []

    def at(self, df: DataFrame, **conds) -> DataFrame:
        """``df`` with counters: the rows where a condition holds, or the sum of a number."""
        seen = Observation(f"{self.job}-{len(self._seen)}")
        self._seen.append((seen, list(conds)))
        return df.observe(seen, *[F.coalesce(F.sum(F.coalesce(c.cast("long"), F.lit(0))), F.lit(0)).alias(k) for k, c in conds.items()])

    @property
    def values(self) -> dict[str, int]:
        """What was counted, once the job's action has run; 0 where no row got as far."""
        out = {}
        for seen, names in self._seen:
            found = observed(seen)
            out |= {k: int(found.get(k, 0)) for k in names}
        return out


def counted(counters: Counters | None, df: DataFrame, **conds) -> DataFrame:
    return df if counters is None else counters.at(df, **conds)


def observe_counters(df: DataFrame, name: str, **conds):
    """F13 during a job's own action: ``(df, observation)``; after the write,
    ``observation.get`` holds ``{counter: count}``. No extra job is run."""
    obs = Observation(name)
    return df.observe(obs, *[F.count_if(c).cast("long").alias(k) for k, c in conds.items()]), obs
