"""Spark session helpers.

The library never creates a session behind the caller's back: every model
function receives DataFrames.  These helpers exist for scripts, tests and the
benchmark, and to resolve the shared checkpoint folder.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "farebox", cpus: int | str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Local session tuned for tests / bench; on a cluster use the cluster's builder."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "*")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.driver.memory", os.environ.get("FAREBOX_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    ``spark.checkpoint.dir`` of the session: a fault-tolerant folder that every
    executor can reach.  A session without executors of their own
    (``local[...]``, as in tests) may leave it unset and gets a private folder;
    on a cluster an unset folder is an error, never a machine-local one.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if sc.getCheckpointDir():
            return sc.getCheckpointDir().rstrip("/").rpartition("/")[0]
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="farebox-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder
