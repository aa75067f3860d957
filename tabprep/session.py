"""Session helpers.

On a cluster the shared checkpoint folder is named by ``spark.checkpoint.dir``;
we read it from the session and only set our own when it is unset (tests,
local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tabprep") -> SparkSession:
    """``shuffle_partitions`` is only set when given: on a cluster its own
    setting (and adaptive execution) decides."""
    builder = SparkSession.builder.appName(app_name)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master:
        builder = builder.master(master)
    spark = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TABPREP_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.  A machine-local one is made only
    where none is configured and all executors are on this machine."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="tabprep-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh path under the shared checkpoint folder, for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tabprep-{name}-{uuid.uuid4().hex}"
