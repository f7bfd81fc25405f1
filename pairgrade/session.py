"""Session helpers.

The library never picks storage on its own when it runs on a cluster: shared
scratch (materialised tables, saved models, ALS / forest checkpoints) lives
under the folder the cluster names in ``spark.checkpoint.dir``.  Only a local
session without that setting (tests, a laptop) gets a fresh temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "pairgrade", driver_memory: str = "8g",
                  **conf: str) -> SparkSession:
    """A session for local runs and tests.  ``driver_memory`` only matters in
    local mode (the driver JVM is the executor) and only before the JVM
    starts; forests need several ``maxMemoryInMB`` histogram buffers per
    running task."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared scratch folder of this session; sets the RDD checkpoint dir too.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir`` from the
    session conf, then (local sessions only) a new temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster run needs a shared "
                "folder for checkpoints and materialised tables")
        configured = tempfile.mkdtemp(prefix="pairgrade-ckpt-")
    elif not _is_local(spark) and configured.startswith("file:"):
        raise RuntimeError(f"spark.checkpoint.dir is {configured}, a folder of one machine; "
                           "a cluster run needs one that all share")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/pairgrade/{name}-{uuid.uuid4().hex}"
