"""Latest snapshot of a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_snapshot(df: DataFrame, at: str, partition: Sequence[str] = ()) -> DataFrame:
    """Rows whose time is the latest, over all or per ``partition``; ties are kept.

    Per partition, the maxima are aggregated first (partially on the map side) and
    met by a semi join on partition and time, so no group is sorted or gathered.
    """
    if not partition:
        return df.filter(F.col(at) == df.agg(F.max(at)).scalar())
    latest = df.groupBy(*partition).agg(F.max(at).alias("__at"))
    # struct keys treat a null partition value as a value
    peak = latest.select(F.struct(*partition, F.col("__at").alias("at")).alias("__peak"))
    here = F.struct(*partition, F.col(at).alias("at"))
    return df.filter(F.col(at).isNotNull()).join(peak, here == F.col("__peak"), "left_semi")
