"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# what one shuffle task should read: fits in execution memory without spilling
SHUFFLE_TASK_BYTES = 128 * 1024**2


def build_session(
    app_name: str = "matchlake", master: str | None = None, shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the jobs assume; `conf` adds or overrides.

    `shuffle_bytes` is the largest shuffle to expect (for the key checks, about 24 bytes per
    match). It sets the number of shuffle partitions; AQE merges them where a shuffle is smaller,
    but cannot add any.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    if shuffle_bytes is not None:
        partitions = max(200, -(-shuffle_bytes // SHUFFLE_TASK_BYTES))
        settings.setdefault("spark.sql.shuffle.partitions", str(partitions))
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master may go without: then one JVM does all the work and a
    temporary folder of this machine is shared enough.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return "file:" + os.path.join(tempfile.gettempdir(), "matchlake-scratch")


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder path under the shared root; Spark makes it on first write."""
    return f"{scratch_root(spark)}/matchlake/{label}-{uuid.uuid4().hex}"
