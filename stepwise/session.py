"""Spark session with the settings that every module assumes."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("stepwise")
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions)).config("spark.driver.memory", memory)
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not _checkpoint_dir(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp")))  # one machine
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    context = spark.sparkContext
    return context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")


def prepare(spark: SparkSession) -> SparkSession:
    """Set what can be set on a running session.

    Checkpoints go to the folder that spark.checkpoint.dir names. Where none is named, one is
    made only if driver and tasks share a machine; on a cluster that is an error, as
    executors couldn't read each other's parts. Folders are listed by a few tasks a core.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * spark.sparkContext.defaultParallelism))  # else a task for each folder of files, up to 10,000
    if not _checkpoint_dir(spark):
        context = spark.sparkContext
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp")))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: that of the checkpoints."""
    return str(_checkpoint_dir(spark))
