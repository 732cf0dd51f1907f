"""Session construction and the few settings the operators rely on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library assumes; a cluster session may already carry them.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "aggrex", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the session the platform gives you."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("AGGREX_DRIVER_MEMORY", "4g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def scale_settings(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for the input: scan splits and shuffle partitions of about
    ``target_partition_bytes`` (so a task's share fits executor memory and
    spills stay small), AQE coalescing toward the same size, and skew
    splitting for partitions several times the median. For 100 TB at 256 MB
    that is ~400k shuffle partitions; AQE merges them when the data shrinks
    after filters and aggregations."""
    n = max(200, -(-int(input_bytes) // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def apply_scale_settings(spark: SparkSession, input_bytes: int, **kw) -> dict[str, str]:
    """Set ``scale_settings`` on a running session (all are runtime SQL confs)."""
    conf = scale_settings(input_bytes, **kw)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object-store) folder there and we use it as
    is. Only when nothing is configured — local tests — do we create one.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="aggrex-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local
