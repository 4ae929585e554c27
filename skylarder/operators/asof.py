"""Each row with the latest row of another series that is not after it."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylarder.session import shared_dir


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_at: str,
    right_at: str,
    on: Sequence[tuple[str, str]] = (),
    order: Sequence[str] = (),
    name: str = "match",
) -> DataFrame:
    """``left`` with the last ``right`` row at or before its time, as the struct ``name``.

    ``on`` pairs key columns (left, right) that must be equal; without them there is one
    series. Of ``right`` rows at the same time the last by ``order`` stands. Every left row
    is kept once; the struct is null where nothing came before, where the time or a key is
    null. Right rows without a time or key match nothing.

    Both sides go into one table, dealt by ranges of key and time and sorted in them, so a
    key of any size spreads over tasks. A task carries the last right row forward. Rows at
    the head of a task whose match lies in an earlier one are met afterwards with what
    that task carried to its end: one row per task, so a broadcast.
    """
    spark = left.sparkSession
    keys = [f"k{i}" for i in range(len(on))]
    ties = [f"o{i}" for i in range(len(order))]

    def side(df: DataFrame, at: str, cols: list[str], right_side: bool) -> DataFrame:
        own = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        return df.select(
            *[F.col(f"`{c}`").alias(k) for c, k in zip(cols, keys)],
            F.col(f"`{at}`").alias("at"),
            F.lit(0 if right_side else 1).alias("side"),
            *[(F.col(f"`{c}`") if right_side else F.lit(None)).alias(o) for c, o in zip(order, ties)],
            # left rows of one instant may part
            (F.lit(0).cast("long") if right_side else F.xxhash64(own)).alias("spread"),
            (F.lit(None) if right_side else own).alias("l"),
            (own if right_side else F.lit(None)).alias("r"),
        )

    lefts, rights = side(left, left_at, [a for a, _ in on], False), side(right, right_at, [b for _, b in on], True)
    known = F.col("at").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    by = [*keys, "at", "side", *ties, "spread"]
    both = rights.where(known).unionByName(lefts.where(known))
    ranged = both.repartitionByRange(*by).sortWithinPartitions(*by).select(*keys, "side", "l", "r")
    path = shared_dir(spark, "asof")
    out = T.StructType([T.StructField("slice", T.IntegerType()), T.StructField("open", T.BooleanType())])
    out = T.StructType(out.fields + [both.schema[c] for c in (*keys, "l", "r")])
    ranged.mapInArrow(lambda batches: _carry(batches, keys), out).write.parquet(path)
    met = spark.read.schema(out).parquet(path)

    done = met.where("l IS NOT NULL AND NOT open").select("l", "r")
    # what each task's last right row was, carried over tasks without one
    ends = met.where("l IS NULL").select("slice", *keys, "r")
    slices = met.select("slice").distinct().join(ends, "slice", "left")
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    held = F.struct(*[F.col(k).alias(k) for k in keys], F.col("r").alias("r"))
    carried = slices.select("slice", F.last(F.when(F.col("r").isNotNull(), held), ignorenulls=True).over(earlier).alias("c"))
    waiting = met.where("l IS NOT NULL AND open").join(F.broadcast(carried), "slice")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"c.{k}"))
    resolved = waiting.select("l", F.when(same, F.col("c.r")).alias("r"))
    unknown = lefts.where(~known).select("l", F.lit(None).cast(both.schema["r"].dataType).alias("r"))
    every = done.unionByName(resolved).unionByName(unknown)
    return every.select(*[F.col(f"l.`{c}`").alias(c) for c in left.columns], F.col("r").alias(name))


def _carry(batches, keys: list[str]):
    """Left rows with the right row before them in this task, and the task's last right row.

    ``open`` marks rows of the task's first key with no right row of it before them here.
    """
    own = TaskContext.get().partitionId()
    head = held = None  # the task's first row and its last right row so far

    def rows_of(batch, rows, found, is_open):
        columns = [batch.column(c).take(rows) for c in (*keys, "l")]
        slices = pa.array(np.full(len(rows), own), pa.int32())
        return pa.RecordBatch.from_arrays([slices, is_open, *columns, found], names=["slice", "open", *keys, "l", "r"])

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        head = head or batch.slice(0, 1)
        place = np.arange(n)
        opens = np.zeros(n, bool)
        for k in keys:
            column = batch.column(k)
            opens[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        key_start = np.maximum.accumulate(np.where(opens, place, 0))
        is_right = batch.column("side").to_numpy(zero_copy_only=False) == 0
        last = np.maximum.accumulate(np.where(is_right, place, -1))
        inside = last >= key_start
        # rows of the key that goes on from the batch before
        goes_on = (key_start == 0) & ~inside

        def continues(one) -> bool:
            return one is not None and all(one.column(k)[0].equals(batch.column(k)[0]) for k in keys)

        from_held = goes_on & continues(held)
        at_head = goes_on & (held is None) & continues(head)
        values = batch.column("r")
        if held is not None:
            values = pa.concat_arrays([held.column("r"), values])
        take = np.where(inside, last + (held is not None), 0)
        rows = np.flatnonzero(~is_right)
        found = values.take(pa.array(take[rows], mask=~(inside | from_held)[rows]))
        yield rows_of(batch, pa.array(rows), found, pa.array(at_head[rows]))
        if last[-1] >= 0:
            held = batch.slice(int(last[-1]), 1)
    if held is not None:
        yield rows_of(held, pa.array([0]), held.column("r"), pa.array([False]))
