"""The latest snapshot of a dataset, found from a listing alone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylarder.sources.readers import or_empty

STAMP = r"_(\d{8}_\d{6})\.[^/]*(?:/.*)?$"
STAMP_FORMAT = "%Y%m%d_%H%M%S"


def _listing(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Path and time of every file of a dataset; contents are not read."""

    def read():
        return (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(root)
            .select("path", "modificationTime")
        )

    files = or_empty(spark, read, "path string, modificationTime timestamp", "empty")
    stamp = F.regexp_extract("path", rf"/{name}{STAMP}", 1)
    return files.withColumn("stamp", stamp).filter("stamp != ''")


def latest_stamp(spark: SparkSession, root: str, name: str, by: str = "name") -> str | None:
    """The time in the name of the latest snapshot, by that time or by file time."""
    latest = {"name": F.max("stamp"), "mtime": F.max_by("stamp", "modificationTime")}[by]
    return _listing(spark, root, name).agg(latest).first()[0]


def read_snapshot(
    spark: SparkSession,
    root: str,
    name: str,
    schema: str,
    fmt: str = "parquet",
    by: str = "name",
    on_missing: str = "empty",
    **options,
) -> DataFrame:
    """The latest snapshot ``{name}_{time}.*`` below ``root``.

    Only one time comes to the driver; the files of that snapshot are then read
    by pattern. Without any snapshot: an error, or no rows.
    """
    stamp = latest_stamp(spark, root, name, by)
    if stamp is None:
        if on_missing == "error":
            raise FileNotFoundError(f"no snapshot of {name} in {root}")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).options(**options)
    return reader.format(fmt).load(f"{root.rstrip('/')}/{name}_{stamp}.*")


def is_fresh(spark: SparkSession, root: str, name: str, now: datetime, seconds: float = 120) -> bool:
    """Whether the latest snapshot is younger than ``seconds``."""
    stamp = latest_stamp(spark, root, name)
    if stamp is None:
        return False
    return now - datetime.strptime(stamp, STAMP_FORMAT) < timedelta(seconds=seconds)
