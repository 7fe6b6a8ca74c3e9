"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC for timestamp parity with the SQL oracle,
# AQE for runtime coalescing / skew-join splitting, Arrow for the few
# pandas-backed operators.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def get_session(master: str | None = None, app: str = "staylens",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    On a cluster ``master`` is left to spark-submit; locally it defaults to
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        b = b.master(master or "local[*]")
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.driver") and not k.startswith("spark.executor"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a running session
                pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and derived tables.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there).  Only when it is unset -- local runs and tests -- a private
    folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint directory
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return d
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        # unset (local runs, tests): a private folder, registered on the
        # context only -- spark.checkpoint.dir cannot be changed at runtime
        d = tempfile.mkdtemp(prefix="staylens-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
