"""The whole run over a lake, from landed files to the index."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from skylarder.operators.duplicates import duplicate_report
from skylarder.operators.quality import stage_count
from skylarder.plans.index import observation_id
from skylarder.plans.meals import explode_meals, format_meals, land_meals
from skylarder.plans.merge import recommend
from skylarder.plans.weather import format_weather, normalise_weather, temperature_series
from skylarder.schemas import (
    FORMATTED_MEALS,
    FORMATTED_WEATHER,
    MEAL_COLUMNS,
    RAW_MEALS,
    RAW_WEATHER,
    RECOMMENDATIONS,
    TIMESERIES,
    WEATHER_RESPONSE,
)
from skylarder.sinks.writers import as_envelopes, as_jsonl, mirror_snapshot, write_index, write_snapshot
from skylarder.sources.readers import read_advice, read_geo, read_shards
from skylarder.sources.snapshots import is_fresh, read_snapshot


class Lake:
    """Where each dataset of a lake lives."""

    def __init__(self, root: str, mirror: str | None = None):
        self.root = root.rstrip("/")
        self.mirror = mirror
        self.meal_shards = f"{self.root}/landing/meals"
        self.responses = f"{self.root}/landing/weather"
        self.advice = f"{self.root}/advice"
        self.geo = f"{self.root}/geo"
        self.raw_meals = f"{self.root}/raw/meals"
        self.raw_weather = f"{self.root}/raw/weather"
        self.formatted_meals = f"{self.root}/formatted/meals"
        self.formatted_weather = f"{self.root}/formatted/weather"
        self.usage = f"{self.root}/usage"
        self.temperature_index = f"{self.root}/index/temperature"
        self.enhanced_index = f"{self.root}/index/enhanced"


def run_once(
    spark: SparkSession, lake: Lake, at: datetime, seed: str = "", compat: bool = False
) -> dict[str, int]:
    """Land, format, merge and index once; returns the rows of each stage.

    Every stage reads the latest snapshot of the stage before it. Weather is not
    landed again while its latest snapshot is younger than two minutes.
    """
    counts: dict[str, int] = {}

    def save(stage, df, root, name, ext, **options):
        counted, seen = stage_count(df, stage)
        path = write_snapshot(counted, root, name, at, ext, **options)
        counts[stage] = seen.get["rows"]
        if lake.mirror:
            mirror_snapshot(spark, path, lake.mirror, **options)

    one_per_file = {"maxRecordsPerFile": 1}
    landed = land_meals(read_shards(spark, lake.meal_shards), at)
    save("raw_meals", as_envelopes(landed), lake.raw_meals, "raw_meals", "json", **one_per_file)
    if not is_fresh(spark, lake.raw_weather, "raw_weather", at):
        responses = spark.read.schema(WEATHER_RESPONSE).json(lake.responses)
        raw = as_envelopes(normalise_weather(responses, at))
        save("raw_weather", raw, lake.raw_weather, "raw_weather", "json", **one_per_file)

    def latest(root, name, schema, fmt="json", on_missing="empty", **options):
        return read_snapshot(spark, root, name, schema, fmt, on_missing=on_missing, **options)

    raw_meals = latest(lake.raw_meals, "raw_meals", RAW_MEALS, on_missing="error", multiLine=True)
    meals = format_meals(explode_meals(raw_meals), at)
    save("formatted_meals", meals, lake.formatted_meals, "formatted_meals", "parquet")
    raw_weather = latest(
        lake.raw_weather, "raw_weather", RAW_WEATHER, on_missing="error", multiLine=True
    )
    weather = format_weather(raw_weather, read_geo(spark, lake.geo), at, compat=compat)
    save(
        "formatted_weather",
        as_envelopes(weather),
        lake.formatted_weather,
        "formatted_weather",
        "json",
        **one_per_file,
    )

    weather = latest(lake.formatted_weather, "formatted_weather", FORMATTED_WEATHER, multiLine=True)
    meals = latest(lake.formatted_meals, "formatted_meals", FORMATTED_MEALS, fmt="parquet")
    series = as_jsonl(temperature_series(weather))
    save("temperature_timeseries", series, lake.usage, "temperature_timeseries", "jsonl")
    advised = recommend(weather, meals, read_advice(spark, lake.advice), seed=seed, compat=compat)
    # the meal columns exist only in records with a meal
    served = as_jsonl(advised, optional=MEAL_COLUMNS, present=F.col("preparation_time").isNotNull())
    save("enhanced_recommendations", served, lake.usage, "enhanced_recommendations", "jsonl")

    series = latest(lake.usage, "temperature_timeseries", TIMESERIES)
    report = duplicate_report(series, exclude=() if compat else ["@timestamp"]).first()
    counts["duplicate_readings"] = report.duplicates
    counts["distinct_patterns"] = report.distinct_patterns
    counts["indexed_temperature"] = write_index(series, lake.temperature_index)
    served = latest(lake.usage, "enhanced_recommendations", RECOMMENDATIONS)
    counts["indexed_enhanced"] = write_index(served, lake.enhanced_index, observation_id(served))
    return counts
