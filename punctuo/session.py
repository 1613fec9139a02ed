"""Session helpers for tests, the bench and the command line.

On a cluster the session comes from the platform; these helpers only fill in
settings that are unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "punctuo") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PUNCTUO_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Settings worth setting on a large cluster (applied by the platform, not here):
# AQE with skew-join splitting and partition coalescing; shuffle partitions
# sized so one partition is ~128–256 MB after the largest shuffle (the
# de-duplication of the raw table); file splits of 128 MB; a shared,
# durable checkpoint folder.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.shuffle.partitions": "auto-size: input bytes / 200 MB (e.g. 100 TB -> 500000)",
    "spark.checkpoint.dir": "a shared folder, e.g. hdfs:///checkpoints or s3a://bucket/checkpoints",
}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; invent one only locally."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) on a cluster")
    path = tempfile.mkdtemp(prefix="punctuo-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
