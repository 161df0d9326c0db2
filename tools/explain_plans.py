"""Print formatted physical plans of the main jobs over a Parquet-backed tenant.

    python tools/explain_plans.py [sf_dir] > plans.txt

The derived tenant is first written as Parquet folders (the layout a real
deployment reads, points partitioned by day), so the plans show what
reaches the scan: PushedFilters, PartitionFilters, ReadSchema, and the join
strategies chosen.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from assetlake.plans import publish as P  # noqa: E402
from assetlake.plans import replicate as R  # noqa: E402
from assetlake.plans.params import RUN_TIME, cfg_events, cfg_ts  # noqa: E402
from assetlake.plans.registry import tenants  # noqa: E402
from assetlake.session import get_spark  # noqa: E402
from assetlake.sources.scan import RESOURCES, ParquetTenant, materialize  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    root = tempfile.mkdtemp(prefix="assetlake-plans-")
    src, tgt = tenants(spark, sf_dir)
    materialize(src, f"{root}/src", [r for r in RESOURCES if r != "ts_points"])
    src.ts_points().withColumn("p_date", F.to_date(F.timestamp_millis("timestamp"))) \
        .write.partitionBy("p_date").parquet(f"{root}/src/ts_points")
    materialize(tgt, f"{root}/tgt", ("assets", "data_sets", "labels", "events", "raw_rows"))
    s, t = ParquetTenant(spark, f"{root}/src"), ParquetTenant(spark, f"{root}/tgt")
    jobs = {
        "replicate_events (delta)": lambda: R.prepare_events(s, t, cfg_events(), RUN_TIME, since_ms=1705708800000),
        "publish_ts_points (previous hour)": lambda: P.publish_ts_points(s, RUN_TIME),
        "publish_ts_points_hour (4 days)": lambda: P.publish_ts_points_hour(s, RUN_TIME),
        "replicate_ts_points (2 days)": lambda: R.prepare_ts_points(s, cfg_ts(), RUN_TIME),
        "publish_sequence_rows": lambda: P.publish_sequence_rows(s, RUN_TIME),
    }
    for name, fn in jobs.items():
        print(f"\n{'=' * 20} {name} {'=' * 20}")
        fn().explain("formatted")


if __name__ == "__main__":
    main()
