"""Typed scans of the lake's files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylarder.schemas import ADVICE, GEO, MEAL_SHARD

MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def or_empty(spark: SparkSession, read, schema, on_missing: str) -> DataFrame:
    """What ``read`` gives, or no rows if its path is missing and that is accepted."""
    if on_missing not in ("error", "empty"):
        raise ValueError(f"on_missing is 'error' or 'empty', not {on_missing!r}")
    try:
        return read()
    except AnalysisException as e:
        if on_missing == "empty" and e.getCondition() in MISSING:
            return spark.createDataFrame([], schema)
        raise


def read_shards(spark: SparkSession, path: str, on_missing: str = "empty") -> DataFrame:
    """Landed meal shards, one document per file; unreadable files give nothing."""

    def read():
        return (
            spark.read.schema(MEAL_SHARD)
            .option("multiLine", True)
            .option("ignoreCorruptFiles", True)
            .option("ignoreMissingFiles", True)
            .json(path)
            .select(F.col("_metadata.file_name").alias("shard"), "meals")
        )

    return or_empty(spark, read, f"shard string, {MEAL_SHARD}", on_missing)


def read_advice(spark: SparkSession, path: str, on_missing: str = "empty") -> DataFrame:
    """Advice per temperature, with ``pos`` ordered as the lines of the file.

    Splits of a large file are ordered by where they start, lines in a split by
    the running id.
    """
    pos = "pos struct<path: string, start: bigint, line: bigint>"

    def read():
        lines = spark.read.schema(ADVICE).option("sep", ";").option("header", True).csv(path)
        place = F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"),
        )
        return lines.select("temperature", "advice", place.alias("pos"))

    return or_empty(spark, read, f"{ADVICE}, {pos}", on_missing)


def read_geo(spark: SparkSession, path: str, on_missing: str = "empty") -> DataFrame:
    return or_empty(spark, lambda: spark.read.schema(GEO).json(path), GEO, on_missing)


def read_history(
    spark: SparkSession, root: str, name: str, fmt: str = "parquet", schema=None, **options
) -> DataFrame:
    """All snapshots of a dataset at once, each row with the time of its snapshot."""
    from skylarder.functions.paths import snapshot_time

    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.format(fmt).load(f"{root.rstrip('/')}/{name}_*")
    return rows.withColumn("snapshot_at", snapshot_time(F.col("_metadata.file_path")))


def parse_json(df: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """JSON text as typed rows, and apart from them the rows that do not parse."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__broken"}
    parsed = df.withColumn(
        "__doc", F.from_json(F.col(column), f"{schema}, __broken string", options)
    )
    broken = F.col("__doc").isNull() | F.col("__doc.__broken").isNotNull()
    good = parsed.filter(~broken).select("__doc.*").drop("__broken")
    return good, parsed.filter(broken).drop("__doc")
