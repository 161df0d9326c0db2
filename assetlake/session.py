"""Spark session set-up shared by jobs, tests and the bench.

Every job runs in UTC (epoch-millis <-> timestamp conversions depend on it)
with AQE on, so shuffle partition counts coalesce and skewed joins split at
run time. The checkpoint folder is read from the cluster's
``spark.checkpoint.dir``; only when that is unset (local tests) do we create
one of our own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only dimensions that are provably small; 32 MB is the
    # ceiling the planner may choose on its own (AQE uses runtime sizes).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    # delete checkpoint files of dimensions and levels once they are unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "assetlake",
              shuffle_partitions: int | None = None,
              conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, settings[k])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is not visible to executors on a cluster
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        # Only reached in local runs and tests, where the driver is the executor.
        configured = tempfile.mkdtemp(prefix="assetlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024
                     ) -> dict[str, str]:
    """Sizing for a cluster run: enough shuffle partitions that each holds about
    ``target_partition_bytes`` of the largest shuffled input (AQE coalesces the
    small ones at run time and splits skewed ones), and file splits of the same
    size so scan tasks fit executor memory. For 100 TB on 1000 executors x 8
    cores this gives ~400k shuffle partitions and 256 MB splits."""
    partitions = max(2 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
