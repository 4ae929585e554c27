"""Meals: landing and formatting."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylarder.functions.meals import clean_steps, prep_time, wide_pairs
from skylarder.operators.dedup import dedup_first
from skylarder.operators.nesting import unnest
from skylarder.operators.sizing import fits, measure
from skylarder.schemas import INGREDIENTS, MEASURES


def land_meals(
    shards: DataFrame, fetched_at: datetime, shard: str = "shard", seen: DataFrame | None = None, stored: bool = False
) -> DataFrame:
    """Merge shards (``shard``, ``meals``) into envelopes, each meal once.

    The first occurrence of an id stands, by shard and place in the shard; null
    shards and meals without an id give nothing, nor do ids of ``seen`` (``id``). Each
    shard keeps an envelope for the meals it was first with, so an envelope is no larger
    than its document was, and declares how many it holds. Which occurrence is the first
    is found from ids and places; whole meals are shuffled once, to their shard. With
    ``stored``, shards are read from files and cheap to read again: whole meals then stay
    where they are, if names tell shards apart and few shards lose a meal.
    """
    ids = shards.select(shard, F.posexplode("meals.idMeal").alias("place", "__id"))
    first = dedup_first(ids, "__id", [shard, "place"])
    if seen is not None:
        first = first.join(seen, F.col("__id") == F.col("id"), "left_anti")
    lossy = _lossy(shards, first, shard) if stored and _told_apart(shards, shard) else None
    if lossy is not None and fits(*measure(lossy)):
        envelopes = _in_place(shards, lossy, shard)
    else:
        envelopes = _regrouped(shards, first, shard)
    return envelopes.select(
        "total_meals",
        F.lit(fetched_at.strftime("%Y%m%d_%H%M%S")).alias("fetch_timestamp"),
        F.col("__kept").alias("meals"),
    )


def _told_apart(shards: DataFrame, shard: str) -> bool:
    """Whether every shard has a name and no two have the same."""
    names = shards.groupBy(shard).agg(F.count(F.lit(1)).alias("n"))
    return names.where(F.col(shard).isNull() | (F.col("n") > 1)).isEmpty()


def _in_place(shards: DataFrame, lossy: DataFrame, shard: str) -> DataFrame:
    """total_meals and __kept of each shard; those of ``lossy`` hold the meals at their places only."""
    met = shards.join(F.broadcast(lossy.withColumn("__lossy", F.lit(True))), shard, "left")
    at_places = F.transform("__places", lambda p: F.get("meals", p))
    kept = met.select(F.when(F.col("__lossy"), at_places).otherwise(F.col("meals")).alias("__kept"))
    return kept.where(F.size("__kept") > 0).select(F.size("__kept").cast("long").alias("total_meals"), "__kept")


def _lossy(shards: DataFrame, first: DataFrame, shard: str) -> DataFrame:
    """Shards that hold other meals than first ones, with the places of the first ones, in order."""
    kept = first.groupBy(shard).agg(F.sort_array(F.collect_list("place")).alias("__places"))
    sizes = shards.select(shard, F.size("meals.idMeal").alias("__size")).where("__size > 0")
    return sizes.join(kept, shard, "left").where("__places IS NULL OR size(__places) < __size").select(shard, "__places")


def _regrouped(shards: DataFrame, first: DataFrame, shard: str) -> DataFrame:
    """total_meals and __kept of each shard, whole meals shuffled to it."""
    arrivals = shards.select(shard, F.posexplode("meals").alias("place", "meal")).withColumn("__id", F.col("meal.idMeal"))
    met = arrivals.unionByName(first.withColumn("__first", F.lit(True)), allowMissingColumns=True).repartition(shard)
    # the mark of a first occurrence sorts before the meal it stands for
    same = Window.partitionBy(shard, "place", "__id").orderBy(F.desc_nulls_last("__first"))
    once = met.withColumn("__marked", F.lag("__first").over(same)).where("__marked")
    placed = F.array_sort(F.collect_list(F.struct("place", "meal")))
    envelopes = once.groupBy(shard).agg(F.count(F.lit(1)).alias("total_meals"), placed.alias("placed"))
    return envelopes.select("total_meals", F.transform("placed", lambda p: p["meal"]).alias("__kept"))


def explode_meals(envelopes: DataFrame) -> DataFrame:
    return unnest(envelopes, "meals")


def add_metadata(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Processing date and one constant processing time for all rows."""
    at = as_of or datetime.now()
    return df.withColumns(
        {
            "processed_date": F.lit(at.date()),
            "processed_timestamp": F.lit(at.isoformat()),
        }
    )


def format_meals(meals: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Flat meals from raw ones; meals without a name (null, not empty) are left out."""
    named = meals.filter(F.col("strMeal").isNotNull())
    formatted = named.select(
        F.col("idMeal").alias("meal_id"),
        F.col("strMeal").alias("meal_name"),
        F.col("strCategory").alias("category"),
        F.col("strArea").alias("region"),
        wide_pairs([F.col(c) for c in INGREDIENTS], [F.col(c) for c in MEASURES]).alias("ingredients"),
        clean_steps(F.col("strInstructions")).alias("instructions"),
        prep_time(F.col("strMeal")).alias("preparation_time"),
        F.col("strMealThumb").alias("image_url"),
    )
    return add_metadata(formatted, as_of)
