"""Weather, advice and meals merged into recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylarder.functions.meals import minutes_text
from skylarder.functions.times import compact_time
from skylarder.functions.weather import fallback_advice, temperature_category
from skylarder.operators.asof import asof_join
from skylarder.operators.nearest import nearest_join
from skylarder.operators.numbering import position_within
from skylarder.operators.pick import hash_number, random_pick
from skylarder.plans.weather import location_columns

_MENU = ("meal_id", "meal_name", "preparation_time", "instructions", "ingredients", "category", "region")


def _record_key() -> Column:
    """What tells one observation from another: where and when."""
    where = ["location.name", "location.latitude", "location.longitude"]
    return F.concat_ws("|", *[F.col(c).cast("string") for c in where], F.col("current.time"))


def recommend(
    weather: DataFrame,
    meals: DataFrame,
    advice: DataFrame,
    key: str | None = None,
    seed: str = "",
    compat: bool = False,
) -> DataFrame:
    """One recommendation per observation with a temperature.

    ``key`` names a column that identifies the observation for the meal pick and
    is kept in the result; by default place and time identify it. ``compat``
    also drops observations of exactly 0.0 degrees. Without meals the meal
    columns are null.
    """
    advised = _advised(weather, advice, key, compat)
    served = random_pick(advised, meals.select(*_MENU), key or "__key", "meal_id", seed, name="meal")
    return _served(served, key)


def recommend_history(
    weather: DataFrame,
    menus: DataFrame,
    advice: DataFrame,
    key: str | None = None,
    seed: str = "",
    menu_at: str = "snapshot_at",
    compat: bool = False,
) -> DataFrame:
    """Recommendations over a whole history: each observation from the menu that was valid then.

    ``menus`` holds the meals of all snapshots, each with the time of its snapshot. An
    observation meets the latest snapshot at or before its time, and picks among the meals
    of that snapshot; before the first one it has no meal. Only one row per snapshot goes
    through the as-of join; the meals are numbered in parallel and met by equality.
    """
    advised = _advised(weather, advice, key, compat)
    order = [F.md5(F.col("meal_id").cast("string")), F.col("meal_id")]
    placed = position_within(menus.select(menu_at, *_MENU).where(F.col(menu_at).isNotNull()), order, [menu_at], name="__pos")
    numbered = placed.select(F.col(menu_at).alias("__menu"), "__pos", F.struct(*_MENU).alias("meal"))
    snapshots = menus.where(F.col(menu_at).isNotNull()).groupBy(F.col(menu_at).alias("menu_at")).agg(F.count(F.lit(1)).alias("meals"))
    timed = advised.withColumn("__at", F.try_to_timestamp("@timestamp"))
    valid = asof_join(timed, snapshots, "__at", "menu_at", name="__valid")
    slot = hash_number(F.concat_ws("|", F.col(key or "__key").cast("string"), F.lit(seed))) % F.col("__valid.meals")
    picked = valid.withColumn("__slot", slot).join(
        numbered, (F.col("__valid.menu_at") == F.col("__menu")) & (F.col("__slot") == F.col("__pos")), "left"
    )
    return _served(picked, key)


def _advised(weather: DataFrame, advice: DataFrame, key: str | None, compat: bool) -> DataFrame:
    """Observations with a temperature, flat, with the nearest advice."""
    temperature = F.col("current.temperature_2m")
    usable = temperature.isNotNull()
    if compat:
        usable = usable & (temperature != 0)
    place = location_columns()
    observed = weather.filter(usable).select(
        (F.col(key) if key else _record_key()).alias(key or "__key"),
        compact_time(F.col("current.time")).alias("@timestamp"),
        place["timezone"].alias("timezone"),
        temperature.alias("current_temperature"),
        F.col("current.relative_humidity_2m").alias("relative_humidity"),
        F.col("current.wind_speed_10m").alias("wind_speed"),
        *[place[c].alias(c) for c in ("location", "latitude", "longitude")],
        temperature_category(temperature).alias("temperature_category"),
        F.get(F.col("daily"), F.lit(0))["uv_index_max"].alias("uv_index_max"),
    )
    return nearest_join(
        observed,
        advice,
        on="current_temperature",
        key="temperature",
        pos="pos",
        value="advice",
        name="recommended_advice",
        fallback=fallback_advice,
    )


def _served(served: DataFrame, key: str | None) -> DataFrame:
    """Recommendations with the meal they picked, if any."""
    minutes = F.when(F.col("meal").isNotNull(), minutes_text(F.col("meal.preparation_time")))
    return served.select(
        *([key] if key else []),
        "@timestamp",
        "timezone",
        "current_temperature",
        "relative_humidity",
        "wind_speed",
        "location",
        "latitude",
        "longitude",
        "recommended_advice",
        "temperature_category",
        "uv_index_max",
        F.col("meal.meal_name").alias("suggested_meal"),
        minutes.alias("preparation_time"),
        F.col("meal.instructions").alias("instructions"),
        F.col("meal.ingredients").alias("ingredients"),
        F.col("meal.category").alias("meal_category"),
        F.col("meal.region").alias("meal_region"),
    )
