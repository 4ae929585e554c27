"""Records as JSON text and content fingerprints."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def fingerprint(columns: Iterable[str]) -> Column:
    """md5 of the record's JSON with keys in sorted order and nulls written out."""
    record = F.struct(*[F.col(f"`{c}`") for c in sorted(columns)])
    return F.md5(F.to_json(record, {"ignoreNullFields": "false"}))


def json_record(columns: Iterable[str]) -> Column:
    """The record as one line of JSON, null members included."""
    record = F.struct(*[F.col(f"`{c}`") for c in columns])
    return F.to_json(record, {"ignoreNullFields": "false"})
