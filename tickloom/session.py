"""Session settings the engine relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Needed for right results: plain decimal text (ANSI), epoch arithmetic (UTC).
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Runtime re-planning: shrink or split shuffle partitions to what they hold.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_WORK_DIR_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING_CONF, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare_session(builder.getOrCreate())


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the settings that decide results on a session made elsewhere."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors could not read it back.
    """
    root = spark.conf.get(_WORK_DIR_KEY, None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{_WORK_DIR_KEY} must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="tickloom-")
        spark.conf.set(_WORK_DIR_KEY, root)
    return root.rstrip("/")


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared root; never reused, never cleared."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
