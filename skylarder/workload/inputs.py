"""The given tables, and the datasets of this package derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylarder.schemas import MEAL_FIELDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def temperature_of(value: Column, event_type: Column) -> Column:
    """A reading as a temperature: errors have none, faint ones are exactly zero."""
    return (
        F.when(event_type == "error", F.lit(None))
        .when(value < 1, F.lit(0.0))
        .otherwise(value % 50 - 5)
    )


def event_temperature() -> Column:
    return temperature_of(F.col("value"), F.col("event_type"))


def advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advice per temperature from parts: sizes are keys, repeated and unsorted."""
    return table(spark, sf_dir, "part").select(
        F.col("p_size").alias("temperature"),
        F.col("p_name").alias("advice"),
        F.col("p_partkey").alias("pos"),
    )


def raw_meals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw meals from parts, with documents as their instructions."""
    part = table(spark, sf_dir, "part")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    given = {
        "idMeal": F.col("p_partkey").cast("string"),
        "strMeal": F.nullif(F.col("p_name"), F.lit("red widget")),
        "strCategory": F.col("p_brand"),
        "strArea": F.col("p_type"),
        "strInstructions": F.col("text"),
        "strMealThumb": F.concat(F.lit("img/"), F.col("p_partkey").cast("string")),
        "strIngredient1": F.col("p_brand"),
        "strMeasure1": F.nullif(F.col("p_type"), F.lit("SMALL")),
        "strIngredient2": F.nullif(F.col("p_type"), F.lit("ECONOMY")),
        "strMeasure2": F.col("p_size").cast("string"),
        "strIngredient20": F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_name")),
        "strMeasure20": F.lit(""),
    }
    missing = F.lit(None).cast("string")
    joined = part.join(documents, F.col("p_partkey") == F.col("doc_id"), "left")
    return joined.select(*[given.get(f, missing).alias(f) for f in MEAL_FIELDS])


def menu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted meals from parts."""
    from skylarder.functions.meals import prep_time

    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("meal_id"),
        F.col("p_name").alias("meal_name"),
        prep_time(F.col("p_name")).alias("preparation_time"),
        F.col("p_type").alias("instructions"),
        F.concat_ws(": ", "p_brand", F.col("p_size").cast("string")).alias("ingredients"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("region"),
    )


def observations(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Formatted weather: one document per event, located at its customer."""
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    located = events.join(customers, F.col("user_id") == F.col("c_custkey"), "left")
    return located.select(
        "event_id",
        F.struct(
            F.nullif(F.col("c_name"), F.lit("Customer#000000007")).alias("name"),
            (F.col("c_nationkey") * 2.5).alias("latitude"),
            (F.col("c_custkey") / 4.0).alias("longitude"),
            F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("timezone"),
        ).alias("location"),
        F.struct(
            iso.alias("time"),
            event_temperature().alias("temperature_2m"),
            (F.col("value") % 100).alias("relative_humidity_2m"),
            (F.col("value") / 8).alias("wind_speed_10m"),
        ).alias("current"),
        F.when(F.col("event_type") == "view", F.array().cast("array<struct<date:string,uv_index_max:double>>"))
        .otherwise(
            F.array(
                F.struct(
                    F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("date"),
                    (F.col("value") % 12).alias("uv_index_max"),
                )
            )
        )
        .alias("daily"),
    )


def menus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Menus of nine days, three days apart, each of some of the parts."""
    day = F.expr("TIMESTAMP '2024-01-03 00:00:00' + make_dt_interval(p_size % 9 * 3)")
    dated = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("meal_id"), day.alias("snapshot_at"))
    return menu(spark, sf_dir).join(dated, "meal_id")


def crowded_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as places: a third within a few hundred metres, the others around the globe, poles included."""
    k = F.col("s_suppkey")
    crowd = k % 3 == 0
    return table(spark, sf_dir, "supplier").select(
        F.when(crowd, 48.0 + k * 0.0001).otherwise(k * 17 % 181 - 90.0).alias("lat"),
        F.when(crowd, 2.0 + k * 0.0001).otherwise(k * 101 % 361 - 180.0).alias("lon"),
        F.col("s_name").alias("city"),
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers around the globe, on the poles and on both sides of the date line."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", (k * 37 % 181 - 90.0).alias("lat_here"), (k * 73 % 361 - 180.0).alias("lon_here")
    )


def land_lake(spark: SparkSession, sf_dir: str, lake) -> None:
    """Files as a lake's sources land them: meal shards and responses as JSON, lookups beside them."""
    from skylarder.operators import renest

    raw = raw_meals(spark, sf_dir)
    shards = renest(raw, items=raw.columns, order=[F.col("idMeal")], keys=["strCategory"], name="meals", max_items=4096)
    shards.select(F.to_json(F.struct("meals")).alias("value")).write.option("maxRecordsPerFile", 1).text(lake.meal_shards, compression="gzip")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    reading = event_temperature()
    responses = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 25 * 2.0).alias("latitude"),
        (F.col("user_id") / 4.0).alias("longitude"),
        F.lit(1.0).alias("elevation"),
        F.when(F.col("event_type") == "view", "b'Etc/UTC'").otherwise("Etc/UTC").alias("timezone"),
        seconds.alias("current_time"),
        F.array(reading, F.col("value") % 100, F.col("value") / 8).alias("current_values"),
        seconds.alias("hourly_start"),
        (seconds + 7200).alias("hourly_end"),
        F.lit(3600).alias("hourly_interval"),
        F.array(reading, F.col("value") % 100).alias("hourly_values"),
        seconds.alias("daily_start"),
        (seconds + 86_400).alias("daily_end"),
        F.lit(86_400).alias("daily_interval"),
        F.array(F.col("value") % 12).alias("daily_values"),
    )
    responses.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.text(lake.responses, compression="gzip")
    advice(spark, sf_dir).orderBy("pos").select("temperature", "advice").write.csv(lake.advice, sep=";", header=True)
    table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 25 * 2.0).alias("lat"),
        (F.col("c_custkey") / 4.0).alias("lon"),
        F.col("c_name").alias("city"),
        F.col("c_mktsegment").alias("country"),
    ).write.json(lake.geo, compression="gzip")
