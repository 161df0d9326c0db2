"""Command line: run one job over Parquet tenants.

    python -m assetlake publish <table> --source DIR --out DIR [--state DIR] [--full-read] [--run-time ISO]
    python -m assetlake replicate <resource> --source DIR --target DIR --out DIR --config FILE.toml [--state DIR]
    python -m assetlake export-points --source DIR --out DIR --external-id XID

Tenants are folders of Parquet tables (``<dir>/<resource>``); ``--out`` is the
published table (publish) or the versioned target snapshot (replicate).

``publish --merge KEY,...`` with ``--state`` keeps older rows: the delta up to the run time is merged into a table of
key buckets. ``replicate --buckets N`` writes targets as tables of N key buckets, of which a run rewrites the touched
ones; points are then kept by day. ``--content`` is the folder of file bodies, ``--quarantine`` takes rejected assets.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from .config import JobConfig
from .operators.filters import to_ms
from .plans import jobs
from .session import get_spark
from .sinks.partitioned import DayTable, KeyedTable
from .sinks.snapshot import SnapshotTable
from .sources.scan import DeltaState, ParquetTenant


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="assetlake")
    ap.add_argument("kind", choices=["publish", "replicate", "export-points"])
    ap.add_argument("name", nargs="?")
    ap.add_argument("--source", required=True)
    ap.add_argument("--target")
    ap.add_argument("--out", required=True)
    ap.add_argument("--config")
    ap.add_argument("--state")
    ap.add_argument("--full-read", action="store_true")
    ap.add_argument("--run-time", default=datetime.now(timezone.utc).isoformat())
    ap.add_argument("--external-id")
    ap.add_argument("--on-invalid", default="fail", choices=["fail", "quarantine"])
    ap.add_argument("--merge", help="key columns: merge the delta instead of replacing the table")
    ap.add_argument("--buckets", type=int, help="key buckets of a replicated target (or of a merged table, 64 by default)")
    ap.add_argument("--content", help="folder of file bodies, by directory and name")
    ap.add_argument("--quarantine", help="snapshot of rejected assets")
    ap.add_argument("--single-file", action="store_true", help="export as one file (small series only)")
    a = ap.parse_args(argv)

    spark = get_spark(app=f"assetlake-{a.kind}-{a.name or ''}")
    src = ParquetTenant(spark, a.source, a.content)
    state = DeltaState(spark, a.state) if a.state else None
    if a.kind == "publish" and a.merge:
        if state is None or a.name not in jobs.DELTA:
            raise SystemExit("--merge needs --state and a table with delta reads")
        keys = a.merge.split(",")
        jobs.run_publish_merge(a.name, src, KeyedTable(spark, a.out, keys, a.buckets or 64), keys, a.run_time, state, a.full_read, until=a.run_time)
        return
    if a.kind == "publish":
        jobs.run_publish(a.name, src, a.out, a.run_time, state, a.full_read)
        return
    if a.kind == "export-points":
        jobs.export_points_text(src, a.out, a.external_id, single_file=a.single_file)
        return
    tgt = ParquetTenant(spark, a.target)
    cfg = JobConfig.from_file(a.config) if a.config else JobConfig()
    name = a.name

    def target(path, *keys):
        return KeyedTable(spark, path, list(keys), a.buckets) if a.buckets else SnapshotTable(spark, path)

    keys = {"raw": ("db_name", "table_name", "key")}.get(name, ("external_id",))
    out = SnapshotTable(spark, a.out) if name == "assets" else target(a.out, *keys)
    if name == "events":
        jobs.run_replicate_events(src, tgt, out, cfg, a.run_time, state, a.full_read)
    elif name == "files":
        jobs.run_replicate_files(src, tgt, out, cfg, a.run_time)
    elif name == "files_metadata":
        jobs.run_replicate_files_metadata(src, tgt, out, cfg, a.run_time, state, a.full_read)
    elif name == "labels":
        jobs.run_replicate_labels(src, tgt, out, cfg)
    elif name == "raw":
        jobs.run_replicate_raw(src, out, cfg)
    elif name == "relationships":
        jobs.run_replicate_relationships(src, tgt, out, cfg)
    elif name == "sequences":
        jobs.run_replicate_sequences(src, tgt, out, target(a.out + "_rows", "seq_external_id", "row_number"), cfg)
    elif name == "ts":
        points = a.out + "_points"
        jobs.run_replicate_ts(src, tgt, out, DayTable(spark, points) if a.buckets else SnapshotTable(spark, points), cfg, a.run_time)
    elif name == "assets":
        jobs.run_replicate_assets(src, tgt, out, cfg, to_ms(a.run_time), a.on_invalid,
                                  SnapshotTable(spark, a.quarantine) if a.quarantine else None)
    else:
        raise SystemExit(f"unknown resource {name!r}")


if __name__ == "__main__":
    main()
