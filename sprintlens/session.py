"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "sprintlens", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stable_dir(spark: SparkSession, name: str) -> str:
    """The folder of this name below the cluster's shared checkpoint folder.

    Only a local master may fall back to a folder of this machine; on a cluster the
    setting is required because executors and driver must see the same files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="sprintlens-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return stable_dir(spark, f"{name}-{uuid.uuid4().hex}")
