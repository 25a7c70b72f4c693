"""Session settings and the durable cut of lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # text timestamps are UTC; day boundaries must not move with the machine
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # month partitions are written side by side; only a task with more months sorts its rows
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # a table of some thousand buckets is listed by a few tasks, not by one for each folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    # a plan's shuffle files go when it has ended, not when the driver happens to collect garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # stored tables take less of the disk than with snappy
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str = "orderlake", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_directory(spark: SparkSession) -> str:
    """Folder every node can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A local-mode session without the setting gets a temporary folder; a cluster
    without it is refused, since a folder of one machine would not survive the loss
    of that machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    in_use = context.getCheckpointDir()
    if configured:
        if in_use is None:
            context.setCheckpointDir(configured)
        return configured
    if in_use is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="orderlake-"))
        in_use = context.getCheckpointDir()
    return in_use


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from files that outlive any executor."""
    shared_directory(df.sparkSession)
    return df.checkpoint(eager=True)
