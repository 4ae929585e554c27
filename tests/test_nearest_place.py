"""The nearest place against all places, with poles, the date line, ties and crowds."""

import importlib
import math
import random

import pytest
from pyspark.sql import functions as F

from skylarder.operators import nearest_place
from skylarder.plans import format_weather
from skylarder.schemas import GEO, RAW_WEATHER
from skylarder.session import shared_dir

tree = importlib.import_module("skylarder.operators.nearest_place")


def metres(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return math.floor(2 * math.asin(min(1.0, math.sqrt(h))) * tree.EARTH_METRES + 0.5)


def found(spark, places, spots, **options):
    p = spark.createDataFrame(places, "lat double, lon double, city string")
    s = spark.createDataFrame([(i, *at) for i, at in enumerate(spots)], "i long, a double, o double")
    rows = nearest_place(s, p, "a", "o", F.col("city"), metres="m", **options).collect()
    return {r.i: (r.place, r.m) for r in rows}


def some(seed, n):
    rng = random.Random(seed)
    spots = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)]
    return spots + [(90.0, 10.0), (-90.0, -170.0), (89.99, 180.0), (0.0, 180.0), (0.0, -180.0), (0.0, 179.999), (12.0, 372.5), (0.0, 0.0), (-0.0, -0.0)]


@pytest.mark.parametrize("leaf", [3, 16])
def test_equals_all_places(spark, leaf):
    rng = random.Random(leaf)
    places = [(a, o, f"p{i % 90}") for i, (a, o) in enumerate(some(leaf, 60))]
    # a crowd within metres of one point, one within a kilometre, and places at the same point
    places += [(51.5 + rng.uniform(-1, 1) * 1e-4, -0.1 + rng.uniform(-1, 1) * 1e-4, f"c{i}") for i in range(120)]
    places += [(-33.9 + rng.uniform(-1, 1) * 1e-2, 151.2 + rng.uniform(-1, 1) * 1e-2, f"s{i}") for i in range(120)]
    places += [(40.0, 40.0, "twin b"), (40.0, 40.0, "twin a"), (40.0, 400.0, "twin c"), (90.0, -77.0, "north"), (None, 1.0, "x"), (1.0, 1.0, None), (95.0, 0.0, "no"), (float("nan"), 0.0, "no")]
    spots = some(leaf + 100, 80) + [(51.5, -0.1), (51.6, -0.3), (-33.9, 151.2), (40.0, 40.0), (40.0, 40.0), (20.0, 40.0)]
    usable = [(a, o, c) for a, o, c in places if a is not None and abs(a) <= 90 and c is not None]
    want = {i: min((metres(a, o, b, p), c) for b, p, c in usable) for i, (a, o) in enumerate(spots)}
    assert found(spark, places, spots, leaf=leaf) == {i: (c, m) for i, (m, c) in want.items()}


def test_what_is_no_position_or_too_far_has_no_place(spark):
    nan = float("nan")
    spots = [(None, 1.0), (1.0, None), (nan, 1.0), (91.0, 1.0), (1.0, float("inf")), (0.0, 0.005), (0.0, 1.0)]
    got = found(spark, [(0.0, 0.0, "here")], spots, within_km=1.0)
    assert got == {i: (None, None) for i in (0, 1, 2, 3, 4, 6)} | {5: ("here", 556)}
    assert found(spark, [], spots[5:]) == {0: (None, None), 1: (None, None)}
    assert found(spark, [(0.0, 0.0, "here")], []) == {}


def test_crowds_elsewhere_are_not_met(spark):
    """Far positions are compared with a few places, though a crowd is the only thing on their side of the globe."""
    crowd = spark.range(5000).select((F.col("id") * 1e-5 + 50).alias("la"), (F.col("id") % 70 * 1e-5).alias("lo"), F.col("id").cast("string").alias("label"))
    sites = tree._on_sphere(crowd, "la", "lo")
    rounds, homes = tree._tree(sites, 16, shared_dir(spark, "t"))
    assert len(rounds) <= 7 and homes.count() == homes.select("label").distinct().count() == 5000
    spots = tree._on_sphere(spark.range(500).select((F.col("id") * 0.1 - 20).alias("la"), (F.col("id") * 0.05 + 30).alias("lo")), "la", "lo")
    met = tree._descend(spots, sites, 16, shared_dir(spark, "t")).groupBy("la", "lo").count().agg(F.count("*"), F.avg("count")).first()
    assert met[0] == 500 and met[1] < 200


def test_weather_is_named_by_the_nearest_place(spark):
    geo = spark.createDataFrame([(10.0, 20.0, "", "Upton", "Testland"), (10.5, 20.0, None, None, None)], GEO)
    raw = [((10.004, 20.004, 1, "UTC", "t"), None, None, None), ((11.5, 20.0, 1, "b'X/Y'", "t"), None, None, None)]
    raw = spark.createDataFrame(raw, RAW_WEATHER)
    names = lambda **o: sorted(r.location.name for r in format_weather(raw, geo, **o).collect())
    assert names(within_km=5) == ["Unknown Location", "Upton, Testland"]
    assert names(within_km=500) == ["Unknown, Unknown", "Upton, Testland"]
    assert names() == ["Unknown Location", "Upton, Testland"]
