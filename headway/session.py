"""Session settings and the shared folder for anything a job has to leave on disk."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster should also use. Broadcast joins are left to the size check of
# ``spark.sql.autoBroadcastJoinThreshold``; larger sides shuffle, and adaptive execution
# splits the hot partitions of those shuffles even where that costs one more exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8,
                  **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("HEADWAY_DRIVER_MEMORY", "12g"),
        # Here driver and executors share one disk; a cluster names a folder that all of them reach.
        "spark.checkpoint.dir": extra.pop("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="headway-"),
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the one every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``, which cannot be set once a session runs;
    ``build_session`` names one for a local session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("start the session with spark.checkpoint.dir, a folder all executors share")
    return f"{root.rstrip('/')}/headway/{purpose}-{uuid.uuid4().hex}"
