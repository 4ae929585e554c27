"""Layers and snapshot names in paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layers by path part, first match wins; the layer of all other
# paths; the time format in snapshot names ``{type}_{category}_{time}.{ext}``.
LAYERS = ("raw", "formatted", "usage")
OTHER_LAYER = "backup"
NAME_TIME = "yyyyMMdd_HHmmss"
NAME_TIME_PATTERN = r"_(\d{8}_\d{6})\."


def layer_of(path: Column) -> Column:
    found = F.lit(OTHER_LAYER)
    for layer in reversed(LAYERS):
        found = F.when(path.contains(f"/{layer}/"), layer).otherwise(found)
    return found


def snapshot_name(kind: str, category: str, at: Column, ext: str) -> Column:
    return F.concat(F.lit(f"{kind}_{category}_"), F.date_format(at, NAME_TIME), F.lit(f".{ext}"))


def snapshot_time(path: Column) -> Column:
    """The time in a snapshot's name, or null if the path has none."""
    return F.try_to_timestamp(F.regexp_extract(path, NAME_TIME_PATTERN, 1), F.lit(NAME_TIME))
