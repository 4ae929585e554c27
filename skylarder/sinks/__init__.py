"""Writers: snapshots, JSON documents, mirrors and the index dataset."""

from skylarder.sinks.writers import (
    append_rows,
    as_envelopes,
    as_jsonl,
    mirror_snapshot,
    write_index,
    write_snapshot,
)

__all__ = [
    "append_rows",
    "as_envelopes",
    "as_jsonl",
    "mirror_snapshot",
    "write_index",
    "write_snapshot",
]
