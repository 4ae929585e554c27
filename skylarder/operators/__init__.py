"""Operators: functions from DataFrames and column names to a DataFrame."""

from skylarder.operators.asof import asof_join
from skylarder.operators.dedup import dedup_first
from skylarder.operators.duplicates import duplicate_examples, duplicate_report
from skylarder.operators.grids import time_grid, zip_short
from skylarder.operators.inventory import inventory_diff, inventory_of, storage_inventory
from skylarder.operators.nearest import nearest_join
from skylarder.operators.nearest_place import nearest_place
from skylarder.operators.nesting import renest, unnest
from skylarder.operators.numbering import position_within
from skylarder.operators.pick import random_pick
from skylarder.operators.places import enrich_place
from skylarder.operators.quality import count_check, empty_to_null, null_counts, stage_count
from skylarder.operators.snapshot import latest_snapshot
from skylarder.operators.throttle import throttle

__all__ = [
    "asof_join",
    "count_check",
    "dedup_first",
    "duplicate_examples",
    "duplicate_report",
    "empty_to_null",
    "enrich_place",
    "inventory_diff",
    "inventory_of",
    "latest_snapshot",
    "nearest_join",
    "nearest_place",
    "null_counts",
    "position_within",
    "random_pick",
    "renest",
    "stage_count",
    "storage_inventory",
    "throttle",
    "time_grid",
    "unnest",
    "zip_short",
]
