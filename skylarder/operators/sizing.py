"""Size checks in front of a broadcast or a single sorting task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 200_000
MAX_BYTES = 64 << 20


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes (as JSON text) of a dimension, from one distributed aggregation."""
    width = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return size.n, size.b or 0


def fits(rows: int, size: int) -> bool:
    return rows <= MAX_ROWS and size <= MAX_BYTES
