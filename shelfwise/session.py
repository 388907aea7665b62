"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: str | int = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """Single-JVM session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("shelfwise")
    conf = {**DEFAULTS, "spark.sql.shuffle.partitions": str(partitions), **extra}
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one run under the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors could not all see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = tempfile.mkdtemp(prefix="shelfwise-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
