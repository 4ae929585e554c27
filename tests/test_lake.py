"""Readers, writers and the whole run on files."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from skylarder.operators import nearest_join
from skylarder.plans.run import Lake, run_once
from skylarder.schemas import MEAL_COLUMNS, RAW_MEALS
from skylarder.sinks import (
    append_rows,
    as_envelopes,
    as_jsonl,
    mirror_snapshot,
    write_index,
    write_snapshot,
)
from skylarder.sources import (
    is_fresh,
    latest_stamp,
    parse_json,
    read_advice,
    read_geo,
    read_history,
    read_shards,
    read_snapshot,
)

AT = datetime(2031, 2, 3, 4, 5, 6)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def lines_of(folder):
    parts = sorted(p for p in os.listdir(folder) if p.startswith("part-"))
    return [line for p in parts for line in open(f"{folder}/{p}", encoding="utf-8").read().splitlines()]


def test_advice_keeps_file_order_and_misses_quietly(spark, tmp_path):
    put(tmp_path / "advice.csv", "temperature;advice\n21;second key first\n20;é\n20;dup\n-3;cold\n")
    advice = read_advice(spark, str(tmp_path / "advice.csv"))
    assert [(r.temperature, r.advice) for r in advice.orderBy("pos").collect()] == [
        (21, "second key first"), (20, "é"), (20, "dup"), (-3, "cold"),
    ]
    t = spark.createDataFrame([(20.5,), (20.4,)], "t double")
    out = nearest_join(t, advice, "t", "temperature", "pos", "advice", "a").collect()
    assert {r.t: r.a for r in out} == {20.5: "second key first", 20.4: "é"}
    assert read_advice(spark, str(tmp_path / "none.csv")).count() == 0
    with pytest.raises(AnalysisException):
        read_advice(spark, str(tmp_path / "none.csv"), on_missing="error")


def test_advice_order_across_file_splits(spark, tmp_path):
    body = "".join(f"{i};line {i}\n" for i in range(20_000))
    put(tmp_path / "big.csv", "temperature;advice\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        advice = read_advice(spark, str(tmp_path / "big.csv"))
        assert advice.select(F.spark_partition_id().alias("p")).distinct().count() > 3
        order = [r.temperature for r in advice.orderBy("pos").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert order == list(range(20_000))


def test_shards_skip_broken_files(spark, tmp_path):
    put(tmp_path / "s" / "a.json", json.dumps({"meals": [{"idMeal": "1", "strMeal": "x"}]}, indent=1))
    put(tmp_path / "s" / "b.json", json.dumps({"meals": None}))
    put(tmp_path / "s" / "c.json", "<html>busy</html>")
    shards = read_shards(spark, str(tmp_path / "s"))
    rows = shards.select("shard", F.explode("meals")).collect()
    assert [(r.shard, r.col.idMeal) for r in rows] == [("a.json", "1")]


def test_snapshots_by_name_time_and_file_time(spark, tmp_path):
    root = str(tmp_path / "formatted" / "meals")
    df = spark.range(3).withColumn("v", F.lit("old"))
    assert latest_stamp(spark, root, "formatted_meals") is None
    assert read_snapshot(spark, root, "formatted_meals", df.schema.simpleString()[7:-1].replace(":", " ")).count() == 0
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root, "formatted_meals", "id bigint", on_missing="error")
    new = write_snapshot(df.withColumn("v", F.lit("new")), root, "formatted_meals", AT)
    old = write_snapshot(df, root, "formatted_meals", AT - timedelta(days=1))
    assert new.endswith("/formatted_meals_20310203_040506.parquet")
    for folder, age in ((new, 1000), (old, 10)):
        for part in os.listdir(folder):
            stamp = datetime.now().timestamp() - age
            os.utime(f"{folder}/{part}", (stamp, stamp))
    read = lambda **o: read_snapshot(spark, root, "formatted_meals", "id bigint, v string", **o)
    assert {r.v for r in read().collect()} == {"new"}
    assert {r.v for r in read(by="mtime").collect()} == {"old"}
    history = read_history(spark, root, "formatted_meals")
    assert history.count() == 6 and history.select("snapshot_at").distinct().count() == 2


def test_freshness_is_strict_at_the_limit(spark, tmp_path):
    root = str(tmp_path / "raw")
    assert not is_fresh(spark, root, "raw_weather", AT)
    write_snapshot(spark.range(1), root, "raw_weather", AT)
    assert is_fresh(spark, root, "raw_weather", AT + timedelta(seconds=119))
    assert not is_fresh(spark, root, "raw_weather", AT + timedelta(seconds=120))


def test_parse_json_splits_good_and_broken(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("{oops",), ('{"k": "x"}',), (None,)], "line string")
    good, bad = parse_json(df, "line", "k int")
    assert good.collect() == [(1,)]
    assert sorted(str(r.line) for r in bad.collect()) == ["None", '{"k": "x"}', "{oops"]


def test_snapshot_formats_and_single_file(spark, tmp_path):
    df = spark.range(100).repartition(4)
    path = write_snapshot(df, str(tmp_path), "one", AT, single_file=True)
    assert len([p for p in os.listdir(path) if p.endswith(".parquet")]) == 1
    rows = write_snapshot(df, str(tmp_path), "rows", AT, ext="rows.json")
    assert spark.read.schema("id bigint").json(rows).count() == 100


def test_envelopes_are_indented_one_per_file_and_read_back(spark, tmp_path):
    meals = [(1, "t", [{"idMeal": "1", "strMeal": "é"}]), (1, "t", [{"idMeal": "2"}])]
    df = spark.createDataFrame(meals, RAW_MEALS).repartition(1)
    path = write_snapshot(as_envelopes(df), str(tmp_path), "raw_meals", AT, "json", maxRecordsPerFile=1)
    assert lines_of(path)[0] == "{" and lines_of(path)[1].startswith("  ")
    back = read_snapshot(spark, str(tmp_path), "raw_meals", RAW_MEALS, "json", multiLine=True)
    assert sorted(r.meals[0].idMeal for r in back.collect()) == ["1", "2"]
    assert mirror_snapshot(spark, path, str(tmp_path / "copy"))
    copy = f"{tmp_path}/copy/backup/raw_meals_20310203_040506.json"
    assert spark.read.schema(RAW_MEALS).json(copy, multiLine=True).count() == 2


def test_jsonl_omits_the_optional_group_only_when_absent(spark):
    df = spark.createDataFrame([(None, "m", None), (1, None, None)], "a int, meal string, time string")
    out = as_jsonl(df, optional=["meal", "time"], present=F.col("meal").isNotNull())
    assert [r.value for r in out.collect()] == ['{"a":null,"meal":"m","time":null}', '{"a":1}']


def test_mirror_goes_by_layer_and_its_failure_does_not_raise(spark, tmp_path):
    path = write_snapshot(spark.range(5), str(tmp_path / "usage"), "x", AT)
    assert mirror_snapshot(spark, path, str(tmp_path / "mirror"))
    assert spark.read.parquet(f"{tmp_path}/mirror/usage/x_20310203_040506.parquet").count() == 5
    blocked = tmp_path / "blocked"
    blocked.write_text("a file, not a folder")
    assert mirror_snapshot(spark, path, str(blocked)) is False


def test_index_grows_only_by_new_documents(spark, tmp_path):
    index = str(tmp_path / "index")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (1, "a")], "x int, y string")
    assert write_index(df, index) == 2
    assert write_index(df, index) == 0
    assert write_index(df.union(spark.createDataFrame([(3, "c")], df.schema)), index) == 1
    assert spark.read.parquet(index).count() == 3


def test_append_rows(spark, tmp_path):
    path = str(tmp_path / "analytics")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "x int, day string")
    append_rows(rows, path, ["day"])
    append_rows(rows, path, ["day"])
    assert spark.read.parquet(path).filter("day = 'a'").count() == 2


@pytest.fixture
def lake(tmp_path):
    root = tmp_path / "lake"
    put(root / "landing/meals/a.json", json.dumps({"meals": [
        {"idMeal": "1", "strMeal": "Bean stew", "strIngredient1": "Bean", "strMeasure1": "", "strInstructions": "Soak.\r\nBoil."},
        {"idMeal": "2", "strMeal": None},
    ]}))
    put(root / "landing/meals/b.json", json.dumps({"meals": [{"idMeal": "1", "strMeal": "copy"}]}))
    response = {
        "latitude": -7.1234, "longitude": 151.25, "elevation": 3.0, "timezone": "b'Test/Reef'",
        "current_time": 1927857600, "current_values": [31.5, 77.0, 4.25],
        "hourly_start": 1927843200, "hourly_end": 1927929600, "hourly_interval": 3600,
        "hourly_values": [26.0 + (i % 22) / 4 for i in range(24)],
        "daily_start": 1927843200, "daily_end": 1927929600, "daily_interval": 86400, "daily_values": [11.4],
    }
    put(root / "landing/weather/now.json", json.dumps(response) + "\n")
    put(root / "advice/advice.csv", "temperature;advice\n31;stroll\n32;swim\n")
    put(root / "geo/geo.json", json.dumps({"lat": -7.12, "lon": 151.25, "city": "Reefton", "country": "Testland"}))
    return Lake(str(root), mirror=str(tmp_path / "mirror"))


def test_geo_reader(spark, lake):
    assert read_geo(spark, lake.geo).count() == 1
    assert read_geo(spark, lake.geo + "-none").count() == 0


def test_whole_run_twice(spark, lake):
    counts = run_once(spark, lake, AT)
    assert counts == {
        "raw_meals": 1, "raw_weather": 1, "formatted_meals": 1, "formatted_weather": 1,
        "temperature_timeseries": 24, "enhanced_recommendations": 1,
        "duplicate_readings": 2, "distinct_patterns": 22,
        "indexed_temperature": 24, "indexed_enhanced": 1,
    }
    record = json.loads(lines_of(f"{lake.usage}/enhanced_recommendations_20310203_040506.jsonl")[0])
    assert record == {
        "@timestamp": "2031-02-03 04:00:00", "timezone": "Test/Reef", "current_temperature": 31.5,
        "relative_humidity": 77.0, "wind_speed": 4.2, "location": "Reefton, Testland",
        "latitude": -7.1234, "longitude": 151.25, "recommended_advice": "stroll",
        "temperature_category": "warm", "uv_index_max": 11.4, "suggested_meal": "Bean stew",
        "preparation_time": "89 minutes", "instructions": "Soak.; Boil.", "ingredients": "Bean: ",
        "meal_category": None, "meal_region": None,
    }
    # a minute later the weather is still fresh, and nothing new reaches the index
    again = run_once(spark, lake, AT + timedelta(seconds=60))
    assert "raw_weather" not in again
    assert (again["indexed_temperature"], again["indexed_enhanced"]) == (0, 0)
    mirrored = os.listdir(lake.mirror)
    assert sorted(mirrored) == ["formatted", "raw", "usage"]


def test_whole_run_in_compat_mode_and_without_meals(spark, lake):
    put_path = lake.meal_shards + "/a.json"
    open(put_path, "w").write(json.dumps({"meals": [{"idMeal": "9", "strMeal": None}]}))
    open(lake.meal_shards + "/b.json", "w").write("{}")
    counts = run_once(spark, lake, AT, compat=True)
    assert counts["formatted_meals"] == 0 and counts["duplicate_readings"] == 0
    record = json.loads(lines_of(f"{lake.usage}/enhanced_recommendations_20310203_040506.jsonl")[0])
    assert record["timezone"] == "b'Test/Reef'"
    assert not set(record) & set(MEAL_COLUMNS)
