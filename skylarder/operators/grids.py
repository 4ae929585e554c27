"""Regular time grids and positional pairing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_grid(start: Column, end: Column, step: Column) -> Column:
    """Epoch seconds from start (inclusive) to end (exclusive), as an array; empty unless the step is above 0."""
    empty = F.array().cast("array<bigint>")
    return F.when((end > start) & (step > 0), F.sequence(start, end - 1, step)).otherwise(empty)


def zip_short(first: Column, second: Column, names: tuple[str, str]) -> Column:
    """Pair two arrays by position up to the end of the shorter one."""
    size = F.least(F.size(first), F.size(second))
    return F.arrays_zip(
        F.slice(first, 1, size).alias(names[0]), F.slice(second, 1, size).alias(names[1])
    )
