"""Session settings the engine relies on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Run-time re-planning with skew splitting; sums that overflow fail instead of turning null.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, partitions: int | None = None, **extra: str) -> SparkSession:
    """A session for tests and the bench; on a cluster pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tradelake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
    )
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Whether Spark deletes a query's shuffle files when it ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Bytes of files a task reads at most.
SPLIT = "spark.sql.files.maxPartitionBytes"

#: Whether lists are collected in a hash table, of many groups at once, or group by group in sorted rows.
HASHED_LISTS = "spark.sql.execution.useObjectHashAggregateExec"

#: How many folders a task may write to at once; for more, Spark sorts its remaining rows by folder.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for what runs inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside are deleted as each ends.

    Otherwise they wait for the driver's next garbage collection, and those of every stage of a long
    run add up.  What is written and read back never asks for them again.
    """
    with setting(spark, RELEASE, "true"):
        yield


def work_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only where the session names none (local tests) is a temporary folder used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tradelake-"))
    return spark.sparkContext.getCheckpointDir()
