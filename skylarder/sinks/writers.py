"""Writers. Spark's commit protocol keeps partial output out of sight."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylarder.functions.encoding import json_record
from skylarder.functions.paths import layer_of
from skylarder.sources.readers import or_empty
from skylarder.sources.snapshots import STAMP_FORMAT

log = logging.getLogger(__name__)

#: days of a batch that are named to prune the index
MAX_DAYS = 4096

# how each file ending is written
FORMATS = {"parquet": "parquet", "json": "text", "jsonl": "text", "rows.json": "json"}


def write_snapshot(
    df: DataFrame,
    root: str,
    name: str,
    at: datetime,
    ext: str = "parquet",
    single_file: bool = False,
    **options,
) -> str:
    """Write ``{root}/{name}_{time}.{ext}`` and return its path.

    A snapshot is a folder written by all tasks. ``single_file`` is for small
    results: it shuffles them into one file rather than running the whole job
    in one task. Use ``maxRecordsPerFile`` to bound file sizes.
    """
    path = f"{root.rstrip('/')}/{name}_{at.strftime(STAMP_FORMAT)}.{ext}"
    rows = df.repartition(1) if single_file else df
    rows.write.mode("overwrite").format(FORMATS[ext]).options(**options).save(path)
    return path


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a Parquet dataset, for analysis over many runs."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def as_envelopes(df: DataFrame) -> DataFrame:
    """Each row as one indented JSON document; write with ``maxRecordsPerFile=1``."""
    document = F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"})
    return df.select(document.alias("value"))


def as_jsonl(df: DataFrame, optional: Sequence[str] = (), present: Column | None = None) -> DataFrame:
    """Each row as a line of JSON. Nulls are written out, except that the
    ``optional`` columns are left out of rows that are not ``present``."""
    if not optional:
        return df.select(json_record(df.columns).alias("value"))
    base = [c for c in df.columns if c not in set(optional)]
    line = F.when(present, json_record(df.columns)).otherwise(json_record(base))
    return df.select(line.alias("value"))


def mirror_snapshot(spark: SparkSession, path: str, mirror_root: str, **options) -> bool:
    """Copy a written snapshot to ``{mirror_root}/{layer}``; a failure is reported, not raised.

    The copy reads what was written, so the job behind it does not run again.
    """
    name = path.rstrip("/").rsplit("/", 1)[-1]
    # JSON is copied as text, so that it stays as written
    fmt = "parquet" if name.endswith(".parquet") else "text"
    try:
        layer = spark.range(1).select(layer_of(F.lit(path))).first()[0]
        indented = name.endswith(".json") and not name.endswith(".rows.json")
        whole = {"wholetext": "true"} if indented else {}
        copy = spark.read.format(fmt).options(**whole).load(path)
        copy.write.mode("overwrite").format(fmt).options(**options).save(
            f"{mirror_root.rstrip('/')}/{layer}/{name}"
        )
    except (PySparkException, Py4JJavaError, OSError) as e:  # storage errors surface as JVM errors
        log.warning("mirror of %s failed: %s", path, e)
        return False
    return True


def days_of(df: DataFrame, at: str = "@timestamp", most: int = MAX_DAYS) -> Callable[[Column], Column]:
    """A filter on the day (the date in front of ``at``) that keeps the days of ``df``.

    The days come to the driver as literals, so that partitions are pruned when the plan
    is made; beyond ``most`` of them every day is kept.
    """
    day = F.substring(F.col(at), 1, 10)
    days = [r[0] for r in df.select(day).where(day.isNotNull()).distinct().limit(most + 1).collect()]
    if len(days) > most:
        return lambda c: F.lit(True)
    return lambda c: c.isin(days) | c.isNull()


def write_index(df: DataFrame, index_path: str, doc_id: Column | None = None, at: str = "@timestamp") -> int:
    """Append the documents that ``index_path`` does not hold yet; returns how many.

    The index is partitioned by the day of ``at``, and a document's identity holds that
    time, so only the days of ``df`` are read. Documents without such a column make an
    index without days, read whole. A run repeated after a failure adds nothing twice.
    ``doc_id`` says what makes a document the same; by default its whole content.
    """
    from skylarder.operators.quality import stage_count
    from skylarder.plans.index import index_docs

    spark = df.sparkSession
    held = "doc_id string, day string"
    existing = or_empty(spark, lambda: spark.read.schema(held).parquet(index_path), held, "empty")
    by_day = ["day"] if at in df.columns else []
    if by_day:
        existing = existing.where(days_of(df, at)(F.col("day")))
    docs = index_docs(df, existing, doc_id)
    if by_day:
        docs = docs.withColumn("day", F.substring(F.col(at), 1, 10))
    added, seen = stage_count(docs, "added")
    added.write.mode("append").partitionBy(*by_day).parquet(index_path)
    return seen.get["rows"]
