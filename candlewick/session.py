"""Session construction and shared-storage helpers.

Cluster jobs must keep durable intermediate state (checkpoints, staged table
versions, streaming checkpoints) in the shared folder named by
``spark.checkpoint.dir``.  That setting is read from the session.  A session
without it is an error, unless driver and executors are one local process,
which gets a private folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Files in the landing zone are small; pack them into fewer tasks.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "candlewick") -> SparkSession:
    """Session for tests and the local bench (one JVM, ``cores`` threads)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CANDLEWICK_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()  # a fresh subfolder of what was set, or None
    if not folder and current:
        folder = os.path.dirname(current)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="candlewick-ckpt-")
    if not current:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
