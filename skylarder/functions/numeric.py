"""Rounding and size formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size units, each 1024 of the one before.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")

# Splits a double into two halves of at most 27 bits each, so that either half
# times a small integer is exact.
_SPLIT = float(2**27 + 1)
_WHOLE = float(2**52)
_LEAST = 5e-324


def round_half_even(value: Column, digits: int) -> Column:
    """Round the exact binary value of a double, ties to even.

    ``bround`` rounds the shortest decimal text of the double, so it takes 0.15
    (stored slightly below) for a tie. Here the distance to the tie is computed
    without rounding error, from the two exact halves of the double.
    """
    scale = float(10**digits)
    x = value.cast("double")
    mag = F.abs(x)
    low = F.floor(mag * scale).cast("double")
    wide = mag * _SPLIT
    high_half = wide - (wide - mag)
    past_tie = (high_half * scale - (low + 0.5)) + (mag - high_half) * scale
    # on the tie itself only an odd number goes up
    up = past_tie >= F.when(low % 2 == 1, 0.0).otherwise(_LEAST)
    sign = F.when(x < 0, -1.0).otherwise(1.0)
    rounded = (low + up.cast("double")) / scale * sign
    return F.when(mag * scale < _WHOLE, rounded).otherwise(F.bround(x, digits))


def round_to_int(value: Column) -> Column:
    return F.rint(value).cast("bigint")


def format_size(size: Column) -> Column:
    """Bytes as text in the largest fitting unit, with one decimal."""
    unit, divisor = F.lit(SIZE_UNITS[-1]), F.lit(float(1024 ** (len(SIZE_UNITS) - 1)))
    for power in reversed(range(len(SIZE_UNITS) - 1)):
        fits = size < 1024 ** (power + 1)
        unit = F.when(fits, SIZE_UNITS[power]).otherwise(unit)
        divisor = F.when(fits, float(1024**power)).otherwise(divisor)
    # a whole number of tenths prints the same under any rounding rule
    shown = round_half_even(size.cast("double") / divisor, 1)
    return F.when(size.isNotNull(), F.format_string("%.1f %s", shown, unit))
