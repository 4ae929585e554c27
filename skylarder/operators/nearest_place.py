"""The nearest place on the globe for every position."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylarder.operators.sizing import MAX_ROWS
from skylarder.session import shared_dir

EARTH_METRES = 6_371_008.8
#: a cell with more places is cut again
LEAF = 16
#: cells of a level are a quarter as wide as those of the level before; the last are 12 m wide
LEVELS = 10
_AXES = ("x", "y", "z")


def metres_between(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance in whole metres."""
    half = F.pow(F.sin(F.radians(lat_b - lat_a) / 2), F.lit(2)) + F.cos(F.radians(lat_a)) * F.cos(
        F.radians(lat_b)
    ) * F.pow(F.sin(F.radians(lon_b - lon_a) / 2), F.lit(2))
    arc = 2 * F.asin(F.least(F.lit(1.0), F.sqrt(half)))
    return F.round(arc * EARTH_METRES).cast("bigint")


def _on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Points of the unit sphere: neither poles nor the date line are special there."""
    a, o = F.radians(F.col(lat)), F.radians(F.col(lon))
    return df.withColumns({"x": F.cos(a) * F.cos(o), "y": F.cos(a) * F.sin(o), "z": F.sin(a)})


def _cell(level: Column) -> Column:
    """The cube of a level that holds a point: the level above 60 bits, then 20 bits for each axis."""
    n = F.call_function("shiftleft", F.lit(1).cast("bigint"), 2 * level)
    at = [F.least(F.floor((F.col(c) + 1) / 2 * n), n - 1).cast("bigint") for c in _AXES]
    place = F.shiftleft(at[0], 40).bitwiseOR(F.shiftleft(at[1], 20)).bitwiseOR(at[2])
    return F.shiftleft(level.cast("bigint"), 60).bitwiseOR(place)


def _valid(lat: str, lon: str) -> Column:
    finite = F.abs(F.col(lon)) < float("inf")
    return F.col(lat).between(-90, 90) & finite & ~F.isnan(lon) & ~F.isnan(lat)


def nearest_place(
    df: DataFrame,
    places: DataFrame,
    lat: str,
    lon: str,
    label: Column,
    name: str = "place",
    metres: str | None = None,
    place_lat: str = "lat",
    place_lon: str = "lon",
    within_km: float | None = None,
    leaf: int = LEAF,
) -> DataFrame:
    """Add the ``label`` of the nearest of ``places``, by great-circle distance in whole metres.

    Of places equally far the smallest label stands, as it does among places at one point.
    Beyond ``within_km``, without places, and for a position that is none (null, not
    finite, latitude past a pole) the label is null. ``metres`` names an optional column
    for the distance. Longitudes may run past the date line.

    Places are sorted into cubes around the sphere; a cube with more than ``leaf`` places is
    cut into cubes as wide as its places lie apart, down to twelve metres. Each distinct
    position goes down that tree and keeps the cubes that can still hold the nearest place:
    those whose near corner is not beyond the far corner of another. It is compared only
    with the places of the cubes it ends in, so a crowd of places elsewhere costs nothing.
    Rows meet their position by equality.
    """
    spark, base = df.sparkSession, shared_dir(df.sparkSession, "nearest-place")
    sites = (
        places.select(F.col(place_lat).cast("double").alias("la"), F.col(place_lon).cast("double").alias("lo"), label.alias("label"))
        .where(_valid("la", "lo") & F.col("label").isNotNull())
        .groupBy("la", "lo")
        .agg(F.min("label").alias("label"))
    )
    _on_sphere(sites, "la", "lo").write.parquet(f"{base}/sites")
    sites = spark.read.parquet(f"{base}/sites")
    spots = df.select(F.col(lat).cast("double").alias("la"), F.col(lon).cast("double").alias("lo")).where(_valid("la", "lo"))
    spots = _on_sphere(spots.distinct(), "la", "lo")

    found = _descend(spots, sites, leaf, base)
    near = F.struct("metres", "label")
    best = found.groupBy("la", "lo").agg(F.min(near).alias("near"))
    if within_km is not None:
        best = best.where(F.col("near.metres") <= within_km * 1000)
    near_at = [F.col("la").alias("__near_la"), F.col("lo").alias("__near_lo")]
    best = best.select(*near_at, F.col("near.label").alias("__near_label"), F.col("near.metres").alias("__near_metres"))
    here = (F.col(lat).cast("double") == F.col("__near_la")) & (F.col(lon).cast("double") == F.col("__near_lo"))
    joined = df.join(best, here, "left")
    added = {name: F.col("__near_label")} | ({metres: F.col("__near_metres")} if metres else {})
    kept = [F.col(f"`{c}`") for c in df.columns if c not in added]
    return joined.select(*kept, *[c.alias(n) for n, c in added.items()])


def _tree(sites: DataFrame, leaf: int, base: str) -> tuple[list[DataFrame], DataFrame]:
    """Cells round by round (parent, cell, n, is_leaf, bounds of its places), and each place with the leaf it is in."""
    spark, rounds, homes = sites.sparkSession, [], None
    sites = sites.withColumns({"parent": F.lit(0).cast("bigint"), "level": F.lit(1)})
    bounds = [f(c).alias(f"{side}_{c}") for c in _AXES for side, f in (("lo", F.min), ("hi", F.max))]
    width = F.greatest(*[F.col(f"hi_{c}") - F.col(f"lo_{c}") for c in _AXES])
    # the level whose cells are no wider than the places lie apart
    apart = F.ceil(F.log(4.0, 2 / width)).cast("int")
    deeper = F.when(width > 0, F.least(F.greatest(F.col("level") + 1, apart), F.lit(LEVELS))).otherwise(LEVELS)
    while True:
        sites = sites.withColumn("cell", _cell(F.col("level")))
        cells = sites.groupBy("parent", "level", "cell").agg(F.count(F.lit(1)).alias("n"), *bounds)
        cells = cells.withColumn("is_leaf", (F.col("n") <= leaf) | (F.col("level") == LEVELS))
        cells.write.parquet(f"{base}/cells={len(rounds)}")
        cells = spark.read.schema(cells.schema).parquet(f"{base}/cells={len(rounds)}")
        rounds.append(cells)
        home = sites.join(cells.where("is_leaf").select("cell"), "cell", "left_semi").select("la", "lo", "label", "cell")
        homes = home if homes is None else homes.unionByName(home)
        crowded = cells.where("NOT is_leaf").select("cell", deeper.alias("deeper"))
        if crowded.isEmpty():
            return rounds, homes
        sites = sites.join(crowded, "cell").select("la", "lo", "label", *_AXES, F.col("cell").alias("parent"), F.col("deeper").alias("level"))


def _reach(side: str) -> Column:
    """Distance from the point to the nearest or farthest corner of the bounds, through the sphere."""
    total = F.lit(0.0)
    for c in _AXES:
        below, above = F.col(f"lo_{c}") - F.col(c), F.col(c) - F.col(f"hi_{c}")
        gap = F.greatest(F.lit(0.0), below, above) if side == "near" else F.greatest(F.abs(below), F.abs(above))
        total = total + gap * gap
    return F.sqrt(total)


def _descend(spots: DataFrame, sites: DataFrame, leaf: int, base: str) -> DataFrame:
    """la, lo, label, metres: each position with the places that can be its nearest."""
    rounds, homes = _tree(sites, leaf, base)
    point = ["la", "lo", *_AXES]
    # a difference of less than a metre may round to none
    slack = 2 / EARTH_METRES
    frontier, ended = spots.withColumn("cell", F.lit(0).cast("bigint")), None
    for k, cells in enumerate(rounds):
        below = F.broadcast(cells) if cells.count() <= MAX_ROWS else cells
        met = frontier.withColumnRenamed("cell", "parent").join(below.drop("level"), "parent")
        seen = met.select(*point, "cell", "is_leaf", _reach("near").alias("near"), _reach("far").alias("far"))
        if ended is not None:
            seen = seen.unionByName(ended)
        least = F.min("far").over(Window.partitionBy("la", "lo"))
        left = seen.withColumn("least", least).where(F.col("near") <= F.col("least") + slack).drop("least")
        left.write.parquet(f"{base}/frontier={k}")
        left = spots.sparkSession.read.schema(left.schema).parquet(f"{base}/frontier={k}")
        ended, frontier = left.where("is_leaf"), left.where("NOT is_leaf").select(*point, "cell")
    places = homes.select("cell", "label", F.col("la").alias("place_la"), F.col("lo").alias("place_lo"))
    far = metres_between(F.col("la"), F.col("lo"), F.col("place_la"), F.col("place_lo"))
    return ended.join(places, "cell").select("la", "lo", "label", far.alias("metres"))
