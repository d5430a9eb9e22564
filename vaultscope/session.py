"""Session helpers.

Every query formats window starts in UTC and assigns event time in UTC, so the
session time zone is pinned to UTC.  Shuffle sizing and AQE are left to the
cluster's configuration when it sets them; only unset keys get defaults here.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings applied to any session a query runs in.
_RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows of a batch may be long texts: bounds what a Python worker and the JVM beside it hold
    "spark.sql.execution.arrow.maxBytesPerBatch": "16MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC and switch on AQE unless the cluster set it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in _RUNTIME_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vaultscope") -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # checkpoints of the position / gap operators are removed once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("VAULTSCOPE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints.

    Uses the context's directory, else ``spark.checkpoint.dir`` from the session.
    Only a local-mode session without either gets a private temporary folder; a
    cluster session without one is an error, since a machine-local folder is not
    visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="vaultscope-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")


# Streaming state at scale: RocksDB keeps state off the JVM heap and, with
# changelog checkpointing, uploads only the changes of each micro-batch.
_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure_streaming(spark: SparkSession, rocksdb: bool = True) -> SparkSession:
    """Streaming defaults (unless the cluster set them): RocksDB state store."""
    configure(spark)
    if rocksdb:
        for key, value in _ROCKSDB.items():
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
    return spark
