"""Storage inventory by layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylarder.functions.numeric import format_size
from skylarder.functions.paths import layer_of


def inventory_of(files: DataFrame, group: str, size: str) -> DataFrame:
    """Files and bytes per group and, in a row with a null group, over all."""
    return (
        files.rollup(group)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
        )
        .withColumn("size", format_size(F.col("bytes")))
    )


def storage_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files, directories and bytes per layer below ``root``, and in total.

    Reads paths and lengths only. A directory counts if it lies below a layer's
    directory and leads to a file; empty directories are not in a file listing.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", layer_of(F.col("path")).alias("layer"))
    )
    totals = inventory_of(files, "layer", "length")

    # every directory on the way from the layer's directory down to the file
    below = F.regexp_extract("path", r"/(?:raw|formatted|usage)/(.*)/[^/]*$", 1)
    steps = F.filter(F.split(below, "/"), lambda s: s != "")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat_ws("/", F.slice(steps, 1, i))
    )
    dirs = (
        files.filter(F.size(steps) > 0)
        .select("layer", F.explode(prefixes).alias("dir"))
        .distinct()
        .rollup("layer")
        .agg(F.count(F.lit(1)).alias("dirs"))
    )
    joined = totals.alias("t").join(dirs.alias("d"), F.col("t.layer").eqNullSafe(F.col("d.layer")), "left")
    return joined.select(
        "t.layer", "files", F.coalesce("dirs", F.lit(0)).alias("dirs"), "bytes", "size"
    )


def inventory_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """What went away between two inventories, per layer."""
    both = before.alias("b").join(
        after.alias("a"), F.col("b.layer").eqNullSafe(F.col("a.layer")), "full"
    )

    def drop_in(c):
        return F.coalesce(F.col(f"b.{c}"), F.lit(0)) - F.coalesce(F.col(f"a.{c}"), F.lit(0))

    return both.select(
        F.coalesce("b.layer", "a.layer").alias("layer"),
        drop_in("files").alias("files_removed"),
        drop_in("dirs").alias("dirs_removed"),
        drop_in("bytes").alias("bytes_freed"),
    ).withColumn("size_freed", format_size(F.col("bytes_freed")))
