"""Readers: typed scans, snapshots and JSON text."""

from skylarder.sources.readers import (
    parse_json,
    read_advice,
    read_geo,
    read_history,
    read_shards,
)
from skylarder.sources.snapshots import is_fresh, latest_stamp, read_snapshot

__all__ = [
    "is_fresh",
    "latest_stamp",
    "parse_json",
    "read_advice",
    "read_geo",
    "read_history",
    "read_shards",
    "read_snapshot",
]
