"""Dense positions without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylarder.operators.sizing import fits, measure
from skylarder.session import shared_dir

# monotonically_increasing_id holds the partition above this bit, the row in it below
_ROW_BITS = 33


def position_within(
    df: DataFrame,
    order: Sequence[Column],
    keys: Sequence[str] = (),
    name: str = "pos",
    total: str | None = None,
) -> DataFrame:
    """Number the rows of each key 0, 1, 2, ... in the order ``order``.

    All rows are dealt by ranges of key and order and sorted within them, so the
    slices follow the data: a key with a large share of all rows spreads over as
    many tasks as its share asks for. Only rows that are equal in key and order stay
    together, so ``order`` should be total. The sorted rows are written once under
    the shared folder, so ``df`` is evaluated once and places don't change when a
    task runs again. What meets is one size per partition and one first row per key, which
    is broadcast if it is small.
    ``total`` names an optional column with the size of the key.
    """
    spark = df.sparkSession
    ranks = [f"__order{i}" for i in range(len(order))]
    # one struct key groups nulls together in the aggregation and in the join
    rows = df.withColumns(dict(zip(ranks, order)) | {"__slot": F.struct(F.lit(0).alias("__all"), *keys)})
    by = ["__slot", *ranks]
    path = shared_dir(spark, "numbering")
    # dealt and sorted before the rows are counted off
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop(*ranks)
    placed = placed.withColumn("__row", F.monotonically_increasing_id())
    placed.write.parquet(path, compression="zstd")
    placed = spark.read.schema(placed.schema).parquet(path)

    def part(row: str) -> Column:
        return F.shiftright(row, _ROW_BITS)

    def local(row: str) -> Column:
        return F.col(row).bitwiseAND((1 << _ROW_BITS) - 1)

    # one row per partition of the sort, so small enough for one task and a broadcast
    sizes = placed.groupBy(part("__row").alias("__slice")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))

    def absolute(rows: DataFrame, row: str, out: str) -> DataFrame:
        met = rows.join(F.broadcast(starts), part(row) == F.col("__slice"))
        return met.withColumn(out, F.col("__start") + local(row)).drop("__slice", "__start")

    if not keys and not total:  # all rows are of one key, whose first row is the first of all
        return absolute(placed, "__row", name).drop("__slot", "__row")
    firsts = placed.groupBy(F.col("__slot").alias("__of")).agg(
        F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    firsts = absolute(firsts, "__first", "__index_first")
    # few keys go to the rows, so that whole rows aren't shuffled again to meet them
    if fits(*measure(firsts)):
        firsts = F.broadcast(firsts)
    numbered = absolute(placed, "__row", "__index").join(firsts, F.col("__slot") == F.col("__of"))
    extra = {name: F.col("__index") - F.col("__index_first")}
    if total:
        extra[total] = F.col("__rows")
    return numbered.withColumns(extra).drop("__slot", "__of", "__row", "__first", "__index_first", "__index", "__rows")
