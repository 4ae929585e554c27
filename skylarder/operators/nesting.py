"""Rows to arrays and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylarder.operators.numbering import position_within

MAX_ITEMS = 256


def renest(
    df: DataFrame,
    items: Sequence[str],
    order: Sequence[Column],
    keys: Sequence[str] = (),
    name: str = "items",
    max_items: int = MAX_ITEMS,
) -> DataFrame:
    """Nest the rows of each key into envelopes of at most ``max_items`` elements.

    Columns: the keys, ``part`` (0, 1, ...), ``total`` (rows of the key), ``n``
    (rows of this envelope) and the ordered array. Long keys become several
    envelopes, so no array grows with the data; together they hold every row.
    """
    placed = position_within(df, order, keys, name="__pos", total="__total")
    element = F.struct("__pos", F.struct(*items).alias("item"))
    nested = (
        placed.withColumn("part", F.floor(F.col("__pos") / max_items))
        .groupBy(*keys, "part")
        .agg(
            F.max("__total").alias("total"),
            F.count(F.lit(1)).alias("n"),
            F.array_sort(F.collect_list(element)).alias("__elements"),
        )
    )
    return nested.withColumn(name, F.transform("__elements", lambda e: e["item"])).drop("__elements")


def unnest(df: DataFrame, array: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per array element with its members as columns; null and empty give none."""
    return df.select(*keep, F.explode(array).alias("__item")).select(*keep, "__item.*")
