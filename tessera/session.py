"""Session helpers.

Library code never creates a session; it receives one. ``local_session`` is for tests
and ``bench.py`` only. ``shared_dir`` resolves the cluster's shared folder from
``spark.checkpoint.dir`` (set by the cluster); only a local test session gets a
fallback folder, created once per process.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: str | None = None


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tessera")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a local one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/ABFS) and is used
    as is. A local test session without one gets a fresh folder under the system temp dir.
    """
    global _LOCAL_FALLBACK
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    configured = (sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
                  or sc.getConf().get("spark.checkpoint.dir", None))
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_FALLBACK is None:
        _LOCAL_FALLBACK = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.sparkContext.setCheckpointDir(_LOCAL_FALLBACK)
    return spark.sparkContext.getCheckpointDir() or _LOCAL_FALLBACK


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return f"{base}/tessera/{purpose}/{uuid.uuid4().hex}"
