"""First-seen deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedup_first(df: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each key in ``order``; rows with a null or empty key go.

    Spark limits the ranked window on the map side as well, so each task sends at
    most one row per key and a hot key costs one row per task.
    """
    present = F.col(key).isNotNull()
    if isinstance(df.schema[key].dataType, T.StringType):
        present = F.col(key) != ""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.filter(present).withColumn("__rank", rank).filter("__rank = 1").drop("__rank")
