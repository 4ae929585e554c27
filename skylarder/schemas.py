"""Schemas of every dataset. Sources are read with these, never with inference."""

from __future__ import annotations

# Member names of the landed documents.
PAIRS = 20
INGREDIENTS = [f"strIngredient{i}" for i in range(1, PAIRS + 1)]
MEASURES = [f"strMeasure{i}" for i in range(1, PAIRS + 1)]
MEAL_FIELDS = [
    "idMeal",
    "strMeal",
    "strCategory",
    "strArea",
    "strInstructions",
    "strMealThumb",
    *INGREDIENTS,
    *MEASURES,
]

_MEAL = ", ".join(f"{name}: string" for name in MEAL_FIELDS)
_CURRENT = (
    "struct<time: string, temperature_2m: double, relative_humidity_2m: double, "
    "wind_speed_10m: double>"
)
_HOURLY = "array<struct<time: string, temperature_2m: double>>"
_DAILY = "array<struct<date: string, uv_index_max: double>>"

MEAL_SHARD = f"meals array<struct<{_MEAL}>>"
RAW_MEALS = f"total_meals bigint, fetch_timestamp string, {MEAL_SHARD}"

FORMATTED_MEALS = (
    "meal_id string, meal_name string, category string, region string, ingredients string, "
    "instructions string, preparation_time int, image_url string, processed_date date, "
    "processed_timestamp string"
)

WEATHER_RESPONSE = (
    "latitude double, longitude double, elevation double, timezone string, "
    "current_time bigint, current_values array<float>, "
    "hourly_start bigint, hourly_end bigint, hourly_interval bigint, hourly_values array<float>, "
    "daily_start bigint, daily_end bigint, daily_interval bigint, daily_values array<float>"
)

RAW_WEATHER = (
    "metadata struct<latitude: double, longitude: double, elevation: bigint, timezone: string, "
    f"fetch_timestamp: string>, current {_CURRENT}, hourly {_HOURLY}, daily {_DAILY}"
)

FORMATTED_WEATHER = (
    "location struct<name: string, latitude: double, longitude: double, timezone: string>, "
    f"current {_CURRENT}, hourly {_HOURLY}, daily {_DAILY}, formatted_timestamp string"
)

ADVICE = "temperature int, advice string"
GEO = "lat double, lon double, city string, town string, country string"

TIMESERIES = (
    "`@timestamp` string, temperature double, timezone string, location string, "
    "latitude double, longitude double"
)

MEAL_COLUMNS = [
    "suggested_meal",
    "preparation_time",
    "instructions",
    "ingredients",
    "meal_category",
    "meal_region",
]
RECOMMENDATIONS = (
    "`@timestamp` string, timezone string, current_temperature double, relative_humidity double, "
    "wind_speed double, location string, latitude double, longitude double, "
    "recommended_advice string, temperature_category string, uv_index_max double, "
    + ", ".join(f"{c} string" for c in MEAL_COLUMNS)
)
