"""Place names for positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylarder.functions.numeric import round_half_even
from skylarder.functions.places import UNKNOWN_PLACE, place_name


def enrich_place(
    df: DataFrame, geo: DataFrame, lat: str, lon: str, name: str = "place", digits: int = 2
) -> DataFrame:
    """Name each position from a dimension (lat, lon, city, town, country).

    Positions meet on rounded coordinates. Repeated dimension entries are reduced
    to one, so the rows of ``df`` are kept one to one. No hint is given: Spark
    broadcasts the dimension when its measured size allows, and otherwise splits
    hot positions in the shuffled join.
    """
    spot = [
        round_half_even(F.col("lat"), digits).alias("__lat"),
        round_half_even(F.col("lon"), digits).alias("__lon"),
    ]
    label = place_name(F.col("city"), F.col("town"), F.col("country"))
    names = geo.select(*spot, label.alias("__name")).groupBy("__lat", "__lon").agg(
        F.min("__name").alias("__name")
    )
    at = (round_half_even(F.col(lat), digits) == F.col("__lat")) & (
        round_half_even(F.col(lon), digits) == F.col("__lon")
    )
    return (
        df.join(names, at, "left")
        .withColumn(name, F.coalesce("__name", F.lit(UNKNOWN_PLACE)))
        .drop("__lat", "__lon", "__name")
    )
