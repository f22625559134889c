"""Session settings and scratch locations."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # many day partitions are listed by a few tasks, not by one each
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    # building plans from Python is several times faster without call sites
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shuffle_partitions(shuffled_bytes: int, target_bytes: int = 512 << 20, at_least: int = 8) -> int:
    """How many shuffle partitions keep each near the target size. Adaptive
    execution merges partitions that turn out small but never adds any, so size
    this for the largest shuffle: 100 TB at 512 MB is about 200,000."""
    return max(at_least, -(-shuffled_bytes // target_bytes))


def build_session(app_name: str = "retailmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on. Executors and
    ``spark.sql.shuffle.partitions`` are left to the caller or spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """All timestamp text, dates and hashes are defined in UTC; folders are listed by few tasks."""
    for key in ("spark.sql.session.timeZone", "spark.sql.sources.parallelPartitionDiscovery.parallelism"):
        spark.conf.set(key, SESSION_CONF[key])
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, never reused directory for checkpoints and intermediate tables.

    It lies in ``spark.checkpoint.dir`` or, where that is unset, in the warehouse
    directory. Every executor and the driver share either of them.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{base.rstrip('/')}/retailmill-{purpose}-{uuid.uuid4().hex}"
