"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "sentrylake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE with skew handling)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Windowed rules keep one small row per (window, key, peer): off-heap state for large key counts.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for written tables and stream checkpoints that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session may fall back to a temporary folder, which is removed when
    the program ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return f"{base.rstrip('/')}/sentrylake/{label}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix=f"sentrylake-{label}-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
