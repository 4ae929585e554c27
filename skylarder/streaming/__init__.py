"""The same jobs on streams of arriving files."""

from skylarder.streaming.jobs import (
    AVAILABLE,
    EVERY_MINUTE,
    dedup_within,
    each_batch,
    first_seen,
    recommend_stream,
    stream_files,
    throttle_stream,
    to_files,
)
from skylarder.streaming.keyed import first_seen_keyed, throttle_keyed
from skylarder.streaming.lake import Batches, lake_stream

__all__ = [
    "Batches",
    "AVAILABLE",
    "EVERY_MINUTE",
    "dedup_within",
    "each_batch",
    "first_seen",
    "first_seen_keyed",
    "lake_stream",
    "recommend_stream",
    "stream_files",
    "throttle_keyed",
    "throttle_stream",
    "to_files",
]
