"""Session helpers: a local session for tests and the bench, and the shared folder of a session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; UI off, UTC, AQE on."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("yearweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", "32m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # PySpark otherwise records the Python call site of every Column
        # function (several JVM round trips each); it only enriches error text.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("YEARWEAVE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):  # one machine: its own folder is shared by all its threads
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="yearweave-ckpt-"))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder that the session names in ``spark.checkpoint.dir``.

    On a cluster this must be a folder all executors share. Raises when none is named.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("no shared folder: set spark.checkpoint.dir to one that the driver and all executors reach")
    return folder.rstrip("/")
