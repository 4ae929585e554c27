"""A reproducible random choice per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylarder.operators.numbering import position_within
from skylarder.operators.sizing import fits, measure

# hex digits of an md5 used as a number: 60 bits, far above any number of choices
_DIGITS = 15


def hash_number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("bigint")


def random_pick(
    df: DataFrame,
    choices: DataFrame,
    key: str,
    choice_key: str,
    seed: str = "",
    name: str = "pick",
) -> DataFrame:
    """Add one row of ``choices``, as a struct, chosen uniformly by a hash of ``key``.

    The choices are numbered in md5 order of their own key and met by equality on
    that number. They are measured first (one aggregation): few choices are
    numbered in one task and broadcast; many are numbered in parallel slices
    and met by a shuffle, which is even because the numbers are hashes. If each
    has a key of its own, only keys are numbered, and whole choices are shuffled
    once, to meet by key. Without choices the struct is null.
    """
    columns = [F.col(f"`{c}`") for c in choices.columns]
    n, size = measure(choices)
    if n == 0:
        kind = choices.select(F.struct(*columns).alias(name)).schema[name].dataType
        return df.withColumn(name, F.lit(None).cast(kind))

    tag = F.md5(F.col(choice_key).cast("string"))
    order = [tag, F.col(choice_key)]
    slotted = df.withColumn("__slot", hash_number(F.concat_ws("|", F.col(key).cast("string"), F.lit(seed))) % F.lit(n))
    few = fits(n, size)
    if not few and _is_unique(choices, choice_key):
        keys = choices.select(F.col(choice_key).alias("__met"))
        placed = position_within(keys, [F.md5(F.col("__met").cast("string")), F.col("__met")], name="__pos")
        there = choices.select(F.col(choice_key).alias("__own"), F.struct(*columns).alias(name))
        picked = slotted.join(placed, F.col("__slot") == F.col("__pos"), "left")
        return picked.join(there, F.col("__met") == F.col("__own"), "left").drop("__slot", "__pos", "__met", "__own")
    if few:
        position = F.row_number().over(Window.orderBy(*order)) - 1
        numbered = F.broadcast(choices.select(position.alias("__pos"), F.struct(*columns).alias(name)))
    else:
        placed = position_within(choices, order, name="__pos")
        numbered = placed.select("__pos", F.struct(*columns).alias(name))

    joined = slotted.join(numbered, F.col("__slot") == F.col("__pos"), "left")
    return joined.drop("__slot", "__pos")


def _is_unique(choices: DataFrame, key: str) -> bool:
    """Whether no two choices have the same key, and none has none."""
    keys = choices.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return keys.where(F.col(key).isNull() | (F.col("__n") > 1)).isEmpty()
