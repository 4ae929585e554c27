"""Duplicate patterns among records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylarder.functions.encoding import fingerprint


def _pattern(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def duplicate_report(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Total records, records beyond the first of their pattern, distinct patterns.

    Equal columns are an equal fingerprint, so grouping by the columns avoids
    hashing every record.
    """
    per_pattern = df.groupBy(*_pattern(df, exclude)).agg(F.count(F.lit(1)).alias("__n"))
    total, distinct = F.coalesce(F.sum("__n"), F.lit(0)), F.count(F.lit(1))
    return per_pattern.agg(
        total.alias("total"),
        (total - distinct).alias("duplicates"),
        distinct.alias("distinct_patterns"),
    )


def duplicate_examples(
    df: DataFrame, at: str, order: Sequence[str], exclude: Sequence[str] = (), n: int = 5
) -> DataFrame:
    """The pattern that appears first among the repeated ones, and its first n times.

    Only the n rows shown are gathered: the pattern is found from grouped counts,
    then its rows are selected by a semi join with that single row.
    """
    pattern = _pattern(df, [*exclude, at])
    first_seen = F.min(F.struct(*order) if len(order) > 1 else order[0])
    repeated = df.groupBy(*pattern).agg(F.count(F.lit(1)).alias("times"), first_seen.alias("first"))
    found = repeated.filter("times > 1").orderBy("first").limit(1).select(
        fingerprint(pattern).alias("fingerprint"), "times", F.struct(*pattern).alias("__pattern")
    )
    # one row by construction
    hit = df.join(F.broadcast(found), F.struct(*pattern) == F.col("__pattern"))
    shown = hit.orderBy(*order).limit(n)
    seen = F.array_sort(F.collect_list(F.struct(*order, F.col(at).alias("__at"))))
    return shown.groupBy("fingerprint", "times").agg(
        F.transform(seen, lambda e: e["__at"]).alias("first_times")
    )
