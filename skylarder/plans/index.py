"""Documents ready for a search index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylarder.functions.encoding import fingerprint
from skylarder.operators.sizing import fits, measure


def with_doc_id(df: DataFrame, doc_id: Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``doc_id``: by default the fingerprint of all columns, times included."""
    return df.withColumn("doc_id", fingerprint(columns or df.columns) if doc_id is None else doc_id)


def observation_id(df: DataFrame) -> Column:
    """Identifies a recommendation by its observation, so that a changed menu or advice adds nothing."""
    where = [c for c in ("@timestamp", "location", "latitude", "longitude") if c in df.columns]
    return fingerprint(where)


def index_docs(
    df: DataFrame,
    existing: DataFrame | None = None,
    doc_id: Column | None = None,
    compat: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Documents to add: each content once, without those already in ``existing``.

    Copies are merged before the shuffle, so a content that makes up a large
    share of the rows costs one row per task. ``compat`` adds every copy again. With
    ``stored``, ``df`` is read from files and cheap to read again: if few values of
    ``doc_id`` repeat, only the rows that have them are shuffled.
    """
    if compat:
        return with_doc_id(df, doc_id)
    once = _first_each(with_doc_id(df, doc_id)) if stored and doc_id is not None else with_doc_id(df.distinct(), doc_id)
    if doc_id is not None and not stored:
        once = once.dropDuplicates(["doc_id"])
    if existing is None:
        return once
    return once.join(existing.select("doc_id"), "doc_id", "left_anti")


def _first_each(docs: DataFrame) -> DataFrame:
    """One row of each ``doc_id``."""
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("__id"))
    if not fits(*measure(repeated)):
        return docs.dropDuplicates(["doc_id"])
    again = F.col("doc_id").eqNullSafe(F.col("__id"))
    several = docs.join(F.broadcast(repeated), again, "left_semi").dropDuplicates(["doc_id"])
    return docs.join(F.broadcast(repeated), again, "left_anti").unionByName(several)
