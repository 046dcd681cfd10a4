"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine relies on. All can be changed at run time, so they also fit a session
# that somebody else has started.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# Shuffled bytes a reduce task should get at most; the adaptive planner merges smaller ones.
TASK_BYTES = 128 * 1024 * 1024


def configure(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Put a running session into the state the engine expects (UTC days, adaptive plans).

    ``shuffle_bytes``, a guess at the largest shuffle, raises the number of shuffle partitions
    so that each fits a task. The adaptive planner can merge partitions that turn out small but
    never makes more. For hourly input the largest shuffle is about a twentieth of it.
    """
    wanted = dict(SETTINGS)
    if shuffle_bytes is not None:
        key = "spark.sql.shuffle.partitions"
        wanted[key] = str(max(int(spark.conf.get(key)), -(-shuffle_bytes // TASK_BYTES)))
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Days are UTC days; in a session of another zone Spark would cut zoned timestamps elsewhere."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"the session's time zone is {zone}, not UTC: call gridmill.session.configure first")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used, but only when Spark runs on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/gridmill-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.mkdtemp(prefix="run-"), "gridmill")
