"""Session defaults and the shared folder for state that must outlive a task."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the settings every job of this package relies on.

    The master and the number of shuffle partitions are left to the deployment;
    pass them through ``conf`` (tests and the bench do).
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # no call-site capture per column: plans here have hundreds of columns
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one run under the folder the cluster names for checkpoints.

    Only a local master, where driver and executors share a disk, may fall back
    to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="skylarder-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def delete_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of this run whose result has been read."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose results are stored.

    Its cleaner acts when the driver collects garbage, which a driver with little to do
    puts off while the shuffle files of a long run pile up.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def rows_at_a_time(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most so many rows go to a Python task at a time; each whole text stands there several times over."""
    before = spark.conf.get(_ROWS_CONF)
    spark.conf.set(_ROWS_CONF, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(_ROWS_CONF, before)
