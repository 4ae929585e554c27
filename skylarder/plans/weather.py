"""Weather: normalising responses, naming places, and the hourly series."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylarder.functions.numeric import round_half_even, round_to_int
from skylarder.functions.places import UNKNOWN_PART, UNKNOWN_PLACE, place_name, repair_timezone
from skylarder.functions.times import compact_time, epoch_to_date, epoch_to_iso
from skylarder.operators.grids import time_grid, zip_short
from skylarder.operators.nearest_place import nearest_place
from skylarder.operators.places import enrich_place

# Decimals of measures and of coordinates; the default time zone.
MEASURE_DIGITS = 1
COORDINATE_DIGITS = 4
DEFAULT_ZONE = "UTC"


def _series(kind: str, stamp, time_name: str, value_name: str) -> Column:
    """Pair the grid of a response's series with its values, both as text and rounded."""
    grid = time_grid(*[F.col(f"{kind}_{part}") for part in ("start", "end", "interval")])
    pairs = zip_short(grid, F.col(f"{kind}_values"), ("at", "value"))
    return F.transform(
        pairs,
        lambda p: F.struct(
            stamp(p["at"]).alias(time_name),
            round_half_even(p["value"], MEASURE_DIGITS).alias(value_name),
        ),
    ).alias(kind)


def normalise_weather(
    responses: DataFrame, fetched_at: datetime | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Nested raw weather from flat responses (epoch times and value vectors)."""
    at = (fetched_at or datetime.now()).isoformat()

    def measure(i: int, name: str) -> Column:
        return round_half_even(F.get(F.col("current_values"), F.lit(i)), MEASURE_DIGITS).alias(name)

    return responses.select(
        *keep,
        F.struct(
            round_half_even(F.col("latitude"), COORDINATE_DIGITS).alias("latitude"),
            round_half_even(F.col("longitude"), COORDINATE_DIGITS).alias("longitude"),
            round_to_int(F.col("elevation")).alias("elevation"),
            F.col("timezone"),
            F.lit(at).alias("fetch_timestamp"),
        ).alias("metadata"),
        F.struct(
            epoch_to_iso(F.col("current_time")).alias("time"),
            measure(0, "temperature_2m"),
            measure(1, "relative_humidity_2m"),
            measure(2, "wind_speed_10m"),
        ).alias("current"),
        _series("hourly", epoch_to_iso, "time", "temperature_2m"),
        _series("daily", epoch_to_date, "date", "uv_index_max"),
    )


def format_weather(
    raw: DataFrame,
    geo: DataFrame,
    as_of: datetime | None = None,
    keep: Sequence[str] = (),
    compat: bool = False,
    within_km: float | None = None,
) -> DataFrame:
    """Raw weather with a named location in place of its metadata.

    A location is the place at the same rounded coordinates, or with ``within_km`` the
    nearest place no farther than that. Byte-string time zones are repaired unless
    ``compat`` asks for them as landed.
    """
    at = raw.withColumns({"__la": F.col("metadata.latitude"), "__lo": F.col("metadata.longitude")})
    if within_km is None:
        named = enrich_place(at, geo, "__la", "__lo", name="__place")
    else:
        label = place_name(F.col("city"), F.col("town"), F.col("country"))
        found = nearest_place(at, geo, "__la", "__lo", label, name="__found", within_km=within_km)
        named = found.withColumn("__place", F.coalesce("__found", F.lit(UNKNOWN_PLACE)))
    zone = F.col("metadata.timezone")
    return named.select(
        *keep,
        F.struct(
            F.col("__place").alias("name"),
            F.col("metadata.latitude").alias("latitude"),
            F.col("metadata.longitude").alias("longitude"),
            (zone if compat else repair_timezone(zone)).alias("timezone"),
        ).alias("location"),
        "current",
        "hourly",
        "daily",
        F.lit((as_of or datetime.now()).isoformat()).alias("formatted_timestamp"),
    )


def location_columns() -> dict[str, Column]:
    """Flat location columns with defaults for a missing time zone and name."""
    return {
        "timezone": F.coalesce("location.timezone", F.lit(DEFAULT_ZONE)),
        "location": F.coalesce("location.name", F.lit(UNKNOWN_PART)),
        "latitude": F.col("location.latitude"),
        "longitude": F.col("location.longitude"),
    }


def temperature_series(weather: DataFrame) -> DataFrame:
    """One row per hour with the location repeated; no hours, no rows."""
    places = [column.alias(name) for name, column in location_columns().items()]
    hours = weather.select(*places, F.explode("hourly").alias("hour"))
    return hours.select(
        compact_time(F.col("hour.time")).alias("@timestamp"),
        F.col("hour.temperature_2m").alias("temperature"),
        "timezone",
        "location",
        "latitude",
        "longitude",
    )
