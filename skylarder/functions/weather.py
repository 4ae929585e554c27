"""Temperature bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (exclusive) with their label, then the label above.
CATEGORY_BANDS = ((5, "cold"), (15, "cool"), (25, "moderate"), (35, "warm"))
CATEGORY_ABOVE = "hot"

# Advice used when there is no advice table.
ADVICE_BANDS = (
    (10, "Perfect weather for hot soups and warm comfort food!"),
    (20, "Great weather for hearty meals and moderate cooking!"),
    (30, "Pleasant weather for fresh dishes and light cooking!"),
)
ADVICE_ABOVE = "Hot weather - perfect for cold dishes and minimal cooking!"


def _band(value: Column, bands, above: str) -> Column:
    label = F.when(value.isNotNull(), F.lit(above))
    for bound, text in reversed(bands):
        label = F.when(value < bound, text).otherwise(label)
    return label


def temperature_category(temperature: Column) -> Column:
    return _band(temperature, CATEGORY_BANDS, CATEGORY_ABOVE)


def fallback_advice(temperature: Column) -> Column:
    return _band(temperature, ADVICE_BANDS, ADVICE_ABOVE)
