"""Jobs on invented meals and weather."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skylarder import plans
from skylarder.schemas import (
    ADVICE,
    FORMATTED_MEALS,
    FORMATTED_WEATHER,
    GEO,
    MEAL_COLUMNS,
    MEAL_SHARD,
    RAW_WEATHER,
    RECOMMENDATIONS,
    TIMESERIES,
    WEATHER_RESPONSE,
)

AT = datetime(2031, 2, 3, 4, 5, 6)


def meal(id, name, **more):
    return {"idMeal": id, "strMeal": name, **more}


def test_land_meals_keeps_first_by_shard_and_place(spark):
    shards = spark.createDataFrame(
        [
            ("b", [meal("1", "late"), meal("2", "two")]),
            ("a", [meal("1", "early"), meal("", "x"), meal(None, "y"), meal("1", "again")]),
            ("c", None),
        ],
        f"shard string, {MEAL_SHARD}",
    )
    rows = plans.land_meals(shards, AT).collect()
    assert {r.fetch_timestamp for r in rows} == {"20310203_040506"}
    landed = [(r.total_meals, [(m.idMeal, m.strMeal) for m in r.meals]) for r in rows]
    assert sorted(landed) == [(1, [("1", "early")]), (1, [("2", "two")])]
    many = spark.createDataFrame([("a", [meal(str(i), "x") for i in range(40)])], f"shard string, {MEAL_SHARD}")
    assert [m.idMeal for m in plans.land_meals(many, AT).first().meals] == [str(i) for i in range(40)]


def test_format_meals(spark):
    shards = spark.createDataFrame(
        [
            ([
                meal("1", "Tomato tarts", strCategory="Side", strArea="French", strIngredient1="Tomato",
                     strMeasure1="3", strIngredient2="", strMeasure2="1", strIngredient20="Salt",
                     strInstructions="Slice.\r\n\r\n Bake. \n", strMealThumb="u"),
                meal("2", None),
                meal("3", ""),
            ],),
            (None,),
            ([],),
        ],
        MEAL_SHARD,
    )
    out = plans.format_meals(plans.explode_meals(shards), AT)
    assert out.schema.simpleString().replace("`", "") == spark.createDataFrame([], FORMATTED_MEALS).schema.simpleString()
    rows = {r.meal_id: r for r in out.collect()}
    assert set(rows) == {"1", "3"}
    r = rows["1"]
    assert (r.ingredients, r.instructions, r.preparation_time) == ("Tomato: 3; Salt", "Slice.; Bake.", 47)
    assert (r.category, r.region, r.image_url) == ("Side", "French", "u")
    assert (str(r.processed_date), r.processed_timestamp) == ("2031-02-03", "2031-02-03T04:05:06")
    assert (rows["3"].preparation_time, rows["3"].ingredients, rows["3"].instructions) == (30, "", "")


def test_normalise_weather(spark):
    row = (-7.12341, 151.24882, 42.5, "b'Test/Reef'", 1927857600, [20.25, 77.04, 3.75],
           1927836000, 1927836000 + 4 * 3600, 3600, [18.65, 17.95, 16.75], 1927836000, 1927836000, 86400, [11.4])
    out = plans.normalise_weather(spark.createDataFrame([row], WEATHER_RESPONSE), AT)
    assert out.schema.simpleString() == spark.createDataFrame([], RAW_WEATHER).schema.simpleString()
    r = out.first()
    assert r.metadata == (-7.1234, 151.2488, 42, "b'Test/Reef'", "2031-02-03T04:05:06")
    assert r.current == ("2031-02-03T04:00:00+00:00", 20.2, 77.0, 3.8)
    # four hours of grid, three values; float32 18.65 lies below the tie, 17.95 and 16.75 do not
    assert [h.time for h in r.hourly] == [f"2031-02-02T{h}:00:00+00:00" for h in (22, 23)] + ["2031-02-03T00:00:00+00:00"]
    assert [h.temperature_2m for h in r.hourly] == [round(float(v), 1) for v in r_floats(row[9])]
    assert r.daily == []


def r_floats(values):
    import struct

    return [struct.unpack("f", struct.pack("f", v))[0] for v in values]


def raw_weather(spark, rows):
    return spark.createDataFrame(rows, RAW_WEATHER)


def test_format_weather(spark):
    geo = spark.createDataFrame([(-7.12, 151.25, "Reefton", None, "Testland")], GEO)
    raw = raw_weather(spark, [
        ((-7.1234, 151.2488, 42, "b'Test/Reef'", "t"), ("t", 1.0, 2.0, 3.0), [("h", 1.0)], []),
        ((10.0, 20.0, 1, None, "t"), ("t", 1.0, 2.0, 3.0), None, None),
    ])
    out = plans.format_weather(raw, geo, AT)
    assert out.schema.simpleString() == spark.createDataFrame([], FORMATTED_WEATHER).schema.simpleString()
    got = {r.location.name: r for r in out.collect()}
    assert got["Reefton, Testland"].location == ("Reefton, Testland", -7.1234, 151.2488, "Test/Reef")
    assert got["Unknown Location"].location.timezone is None
    compat = plans.format_weather(raw, geo, AT, compat=True).filter("location.name like 'Reefton%'").first()
    assert compat.location.timezone == "b'Test/Reef'"


def weather(spark, rows):
    return spark.createDataFrame(rows, FORMATTED_WEATHER)


def test_temperature_series(spark):
    out = plans.temperature_series(weather(spark, [
        (("Reefton, Testland", -7.13, 151.24, "Test/Reef"), None,
         [("2031-02-02T22:00:00+00:00", 18.7), ("2031-02-02T23:00:00+00:00", None)], [], "t"),
        ((None, None, None, None), None, [("2031-02-03T00:00:00+00:00", 1.0)], [], "t"),
        (("none", 1.0, 1.0, "Z"), None, [], [], "t"),
        (("none", 1.0, 1.0, "Z"), None, None, [], "t"),
    ]))
    assert out.schema.simpleString() == spark.createDataFrame([], TIMESERIES).schema.simpleString()
    assert sorted(map(tuple, out.collect())) == [
        ("2031-02-02 22:00:00", 18.7, "Test/Reef", "Reefton, Testland", -7.13, 151.24),
        ("2031-02-02 23:00:00", None, "Test/Reef", "Reefton, Testland", -7.13, 151.24),
        ("2031-02-03 00:00:00", 1.0, "UTC", "Unknown", None, None),
    ]


def advice(spark, rows):
    df = spark.createDataFrame(rows, ADVICE)
    return df.withColumn("pos", F.monotonically_increasing_id())


def observations(spark, temps, daily=(("d", 11.4),)):
    return weather(spark, [
        ((f"place {i}", 1.0, 2.0, "Z"), ("2031-02-03T19:30:00+00:00", t, 77.0, 3.8), [], list(daily), "t")
        for i, t in enumerate(temps)
    ])


@pytest.fixture
def meals(spark):
    rows = [(str(i), f"meal {i}", "c", "r", "i", "s", 40 + i, "u", None, None) for i in range(3)]
    return spark.createDataFrame(rows, FORMATTED_MEALS)


def test_recommend(spark, meals):
    table = advice(spark, [(21, "later"), (20, "x"), (20, "y")])
    out = plans.recommend(observations(spark, [20.5, 0.0, None, 20.0]), meals, table)
    assert out.schema.simpleString() == spark.createDataFrame([], RECOMMENDATIONS).schema.simpleString()
    rows = {r.location: r for r in out.collect()}
    assert set(rows) == {"place 0", "place 1", "place 3"}
    r = rows["place 0"]
    assert (r["@timestamp"], r.current_temperature, r.relative_humidity, r.wind_speed) == ("2031-02-03 19:30:00", 20.5, 77.0, 3.8)
    assert (r.recommended_advice, r.temperature_category, r.uv_index_max) == ("later", "moderate", 11.4)
    assert rows["place 3"].recommended_advice == "x"
    assert r.suggested_meal.startswith("meal ") and r.preparation_time == f"{40 + int(r.suggested_meal[-1])} minutes"


def test_recommend_compat_drops_zero(spark, meals):
    out = plans.recommend(observations(spark, [20.5, 0.0, None]), meals, advice(spark, [(1, "a")]), compat=True)
    assert [r.location for r in out.collect()] == ["place 0"]


def test_recommend_without_meals_advice_or_daily(spark, meals):
    out = plans.recommend(observations(spark, [12.0], daily=()), meals.limit(0), advice(spark, []))
    r = out.first()
    assert r.recommended_advice.startswith("Great weather") and r.uv_index_max is None
    assert [r[c] for c in MEAL_COLUMNS] == [None] * 6


def test_index_docs_is_idempotent(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, `@timestamp` string")
    first = plans.index_docs(df)
    assert first.count() == 2
    assert plans.index_docs(df, existing=first).count() == 0
    assert plans.index_docs(df, compat=True).count() == 3
