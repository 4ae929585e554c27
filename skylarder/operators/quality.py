"""Null handling, counts and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def empty_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """Empty text becomes null; white space is left alone."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns})


def null_counts(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: all rows, and per required column how many are null."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in required]
    return df.agg(F.count(F.lit(1)).alias("total"), *nulls)


def stage_count(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass; read ``observation.get`` after the action."""
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def count_check(envelopes: DataFrame, array: str, declared: str) -> DataFrame:
    """One row: elements found in the arrays, elements declared, and whether they agree."""
    found = F.coalesce(F.sum(F.coalesce(F.size(array), F.lit(0))), F.lit(0))
    said = F.coalesce(F.sum(declared), F.lit(0))
    return envelopes.agg(
        found.alias("found"), said.alias("declared"), (found == said).alias("consistent")
    )
