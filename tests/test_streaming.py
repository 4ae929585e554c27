"""Streams give what the batch jobs give, over several batches and restarts."""

import json
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from skylarder import streaming
from skylarder.operators import throttle
from skylarder.plans import recommend
from skylarder.plans.run import Lake, run_once
from skylarder.schemas import FORMATTED_MEALS, RECOMMENDATIONS, TIMESERIES
from skylarder.sinks.writers import days_of, write_index
from skylarder.workload import inputs

SCHEMA = "id bigint, key string, at timestamp"
START = datetime(2024, 1, 1)


def drop_file(spark, folder, rows, n):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(f"{folder}/f{n}")


def arrivals(seed=1, n=900):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["hot", "hot", "a", "b"]), START + timedelta(seconds=rng.randrange(20_000))) for i in range(n)]
    return sorted(rows, key=lambda r: r[2])


def stream(spark, folder):
    return streaming.stream_files(spark, f"{folder}/*", SCHEMA, maxFilesPerTrigger=1)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def test_first_seen_across_batches_and_restart(spark, base):
    rows = arrivals()
    drop_file(spark, f"{base}/in", rows[:300], 0)
    run = lambda: streaming.first_seen(
        stream(spark, f"{base}/in"), "key", ["at", "id"], f"{base}/out", f"{base}/cp"
    ).awaitTermination()
    run()
    drop_file(spark, f"{base}/in", rows[300:] + [(9999, "late", START)], 1)
    run()
    run()
    first = {}
    for row in rows:
        first.setdefault(row[1], row[0])
    first["late"] = 9999
    assert {r.key: r.id for r in spark.read.parquet(f"{base}/out").collect()} == first


def test_repeating_a_batch_changes_nothing(spark, base):
    """A batch that ran before a failure runs again with the same id."""
    drop_file(spark, f"{base}/in", arrivals(n=50), 0)
    steps = []
    keep = streaming.jobs.each_batch

    def twice(df, step, checkpoint, trigger):
        def again(batch, batch_id):
            step(batch, batch_id)
            step(batch, batch_id)
            steps.append(batch_id)

        return keep(df, again, checkpoint, trigger)

    streaming.jobs.each_batch = twice
    try:
        streaming.first_seen(stream(spark, f"{base}/in"), "key", ["id"], f"{base}/out", f"{base}/cp").awaitTermination()
        streaming.throttle_stream(
            stream(spark, f"{base}/in"), "key", "at", 120, "id", f"{base}/out2", f"{base}/state", f"{base}/cp2"
        ).awaitTermination()
    finally:
        streaming.jobs.each_batch = keep
    assert steps
    assert spark.read.parquet(f"{base}/out").count() == 3
    batch = throttle(spark.read.schema(SCHEMA).json(f"{base}/in/*"), "key", "at", 120, "id")
    assert spark.read.parquet(f"{base}/out2").count() == batch.count()


def test_dedup_within_forgets_nothing_inside_the_delay(spark, base):
    rows = arrivals(seed=2)
    for n in range(3):
        drop_file(spark, f"{base}/in", rows[n * 300 : (n + 1) * 300], n)
        streaming.to_files(
            streaming.dedup_within(stream(spark, f"{base}/in"), "key", "at", "1 day"), f"{base}/out", f"{base}/cp"
        ).awaitTermination()
    assert sorted(r.key for r in spark.read.parquet(f"{base}/out").collect()) == ["a", "b", "hot"]


def test_throttle_stream_equals_batch(spark, base):
    rows = arrivals(seed=3)
    for n in range(3):
        drop_file(spark, f"{base}/in", rows[n * 300 : (n + 1) * 300], n)
        streaming.throttle_stream(
            stream(spark, f"{base}/in"), "key", "at", 120, "id", f"{base}/out", f"{base}/state", f"{base}/cp"
        ).awaitTermination()
    whole = throttle(spark.createDataFrame(rows, SCHEMA), "key", "at", 120, "id")
    assert sorted(r.id for r in spark.read.parquet(f"{base}/out").collect()) == sorted(r.id for r in whole.collect())


def test_keyed_throttle_equals_batch_and_lets_idle_keys_go(spark, base):
    rows = arrivals(seed=4)
    out = lambda: streaming.throttle_keyed(stream(spark, f"{base}/in"), "key", "at", 120, "id", "10 minutes")
    for n in range(3):
        drop_file(spark, f"{base}/in", rows[n * 300 : (n + 1) * 300], n)
        query = streaming.to_files(out(), f"{base}/out", f"{base}/cp")
        query.awaitTermination()
    whole = throttle(spark.createDataFrame(rows, SCHEMA), "key", "at", 120, "id")
    kept = sorted(r.id for r in spark.read.parquet(f"{base}/out").collect())
    assert kept == sorted(r.id for r in whole.collect())
    # long after, one new key: the others' state is gone
    for n, day in ((3, 1), (4, 2)):
        drop_file(spark, f"{base}/in", [(5000 + n, "new", START + timedelta(days=day)), (6000 + n, None, START + timedelta(days=day))], n)
        query = streaming.to_files(out(), f"{base}/out", f"{base}/cp")
        query.awaitTermination()
    progress = [p for p in query.recentProgress if p["stateOperators"]]
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 8
    assert {5003, 5004, 6003, 6004} <= {r.id for r in spark.read.parquet(f"{base}/out").collect()}
    # a row behind the watermark is dropped
    drop_file(spark, f"{base}/in", [(7000, "late", START)], 5)
    streaming.to_files(out(), f"{base}/out", f"{base}/cp").awaitTermination()
    assert spark.read.parquet(f"{base}/out").where("id = 7000").count() == 0


def test_keyed_first_seen_looks_up_its_own_keys(spark, base):
    rows = [(i, f"k{i % 400}", START + timedelta(seconds=1000 - i)) for i in range(800)] + [(9000, None, START), (9001, "", START)]
    updates = []
    for n, part in enumerate((rows, [(10_000, "k1", START), (10_001, "fresh", START), (10_002, "fresh", START - timedelta(days=1))])):
        drop_file(spark, f"{base}/in", part, n)
        first = streaming.first_seen_keyed(stream(spark, f"{base}/in"), "key", ["at", "id"])
        query = streaming.to_files(first, f"{base}/out", f"{base}/cp")
        query.awaitTermination()
        updates.append(sum(o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"]))
    want = {f"k{i}": 400 + i for i in range(400)} | {"fresh": 10_002}
    assert {r.key: r.id for r in spark.read.parquet(f"{base}/out").collect()} == want
    assert updates == [400, 1]


def test_recommend_stream_equals_batch(spark, base, small_tables):
    events = inputs.table(spark, small_tables, "events")
    customers = inputs.table(spark, small_tables, "customer")
    meals, advice = inputs.menu(spark, small_tables), inputs.advice(spark, small_tables)
    arriving = streaming.stream_files(spark, small_tables, events.schema, "parquet", pattern="events.parquet")
    streaming.recommend_stream(
        inputs.observations(arriving, customers), meals, advice, f"{base}/out", f"{base}/cp", key="event_id"
    ).awaitTermination()
    want = recommend(inputs.observations(events, customers), meals, advice, key="event_id")
    got = spark.read.parquet(f"{base}/out").drop("batch")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def response(n, t=None, at=None, **more):
    """A response of one hour more each time, hours apart from the one before."""
    return {
        "latitude": 1.0, "longitude": 2.0, "elevation": 3.0, "timezone": "UTC",
        "current_time": (1704067200 + n * 600) if at is None else at, "current_values": [20.5 + n if t is None else t, 50.0, 1.0],
        "hourly_start": 1704067200, "hourly_end": 1704070800 + n * 3600, "hourly_interval": 3600,
        "hourly_values": [1.0] * (n + 1), "daily_start": 0, "daily_end": 0,
        "daily_interval": 86400, "daily_values": [], **more,
    }


@pytest.fixture
def landing(base):
    root = Path(base) / "lake"
    for folder in ("landing/weather", "landing/meals", "advice", "geo"):
        (root / folder).mkdir(parents=True)
    (root / "advice/a.csv").write_text("temperature;advice\n20;stroll\n21;swim\n")
    (root / "geo/g.json").write_text(json.dumps({"lat": 1.0, "lon": 2.0, "town": "T", "country": "C"}))

    def land(n, doc, kind="weather"):
        (root / f"landing/{kind}/{n}.json").write_text(doc if isinstance(doc, str) else json.dumps(doc))

    def run(spark, checkpoint="cp", mirror=None, **options):
        lake = Lake(str(root), mirror=mirror)
        streaming.lake_stream(spark, lake, f"{base}/{checkpoint}", streaming.AVAILABLE, **options).awaitTermination()
        return streaming.Batches(spark, str(root))

    return root, land, run


def rows_of(store, dataset, schema, drop=("run", "batch")):
    return sorted(map(str, store.read(dataset, schema).drop(*drop).collect()))


def test_lake_stream_over_batches_and_restart(spark, base, landing):
    root, land, run = landing
    land("a", {"meals": [{"idMeal": "1", "strMeal": "pie"}, {"idMeal": "2", "strMeal": None}]}, "meals")
    land(0, response(0))
    land(1, response(1))
    # files of the same instant arrive in either order, so nothing is throttled here
    store = run(spark, maxFilesPerTrigger=1, gap_seconds=None)
    land("b", {"meals": [{"idMeal": "1", "strMeal": "copy"}, {"idMeal": "3", "strMeal": "soup"}]}, "meals")
    land(2, response(2) | {"timezone": "b'UTC'"})
    run(spark, maxFilesPerTrigger=1, gap_seconds=None)
    run(spark, maxFilesPerTrigger=1, gap_seconds=None)
    assert [r.meal_name for r in store.read("formatted_meals", FORMATTED_MEALS).orderBy("meal_id").collect()] == ["pie", "soup"]
    # hours overlap between responses and are indexed once
    assert store.read("temperature_index", TIMESERIES).count() == 3
    served = store.read("enhanced_index", RECOMMENDATIONS).orderBy("current_temperature").collect()
    assert [r.recommended_advice for r in served] == ["stroll", "swim", "swim"]
    assert {r.suggested_meal for r in served} <= {"pie", "soup"} and {r.location for r in served} == {"T, C"}
    # a lost checkpoint replays every file as a new run, and the index stays as it is
    run(spark, "cp-new", gap_seconds=None)
    assert store.read("temperature_index", TIMESERIES).count() == 3
    assert store.read("enhanced_index", RECOMMENDATIONS).count() == 3


def test_lake_stream_equals_the_whole_run(spark, base, landing):
    root, land, run = landing
    meals = [{"idMeal": str(i % 7), "strMeal": f"meal {i}" if i % 5 else None, "strIngredient1": "x"} for i in range(20)]
    for name, part in (("a", meals[:8]), ("b", meals[8:]), ("c", None)):
        land(name, {"meals": part}, "meals")
    land(0, "\n".join(json.dumps(response(n)) for n in range(6)) + "\n\n")
    store = run(spark, seed="s", mirror=f"{base}/mirror")
    lake = Lake(str(root))
    counts = run_once(spark, lake, START, seed="s")
    report = store.marked().first().report
    for dataset in ("formatted_meals", "temperature_timeseries", "enhanced_recommendations"):
        assert int(report[dataset]) == counts[dataset]
    assert (int(report["temperature_index"]), int(report["enhanced_index"])) == (counts["indexed_temperature"], counts["indexed_enhanced"])
    assert (int(report["duplicate_readings"]), int(report["distinct_patterns"])) == (counts["duplicate_readings"], counts["distinct_patterns"])
    assert report["meals_declared"] == report["meals_found"] and report["broken"] == "0"
    assert report["duplicate_example"].startswith("2024-01-01 00:00:00")
    for dataset, path, schema in (("temperature_index", lake.temperature_index, TIMESERIES), ("enhanced_index", lake.enhanced_index, RECOMMENDATIONS)):
        assert rows_of(store, dataset, schema) == sorted(map(str, spark.read.schema(schema).parquet(path).drop("day").collect()))
    layers = {p.name for p in Path(f"{base}/mirror").iterdir()}
    assert layers == {"raw", "formatted", "usage"}


def test_a_batch_that_dies_is_invisible_and_repeated(spark, base, landing, monkeypatch):
    root, land, run = landing
    land("a", {"meals": [{"idMeal": "1", "strMeal": "pie"}]}, "meals")
    land(0, response(0))
    store = run(spark)
    land(1, response(1))
    write = streaming.Batches.write

    def failing(self, df, dataset, r, b, **facts):
        if dataset == "enhanced_index":
            raise OSError("disk gone")
        return write(self, df, dataset, r, b, **facts)

    monkeypatch.setattr(streaming.Batches, "write", failing)
    with pytest.raises(StreamingQueryException):
        run(spark)
    monkeypatch.undo()
    assert store.marked().count() == 1 and store.read("temperature_index", TIMESERIES).count() == 1
    assert store.read("landed", "kind string").count() == 2
    run(spark)
    assert store.marked().count() == 2 and store.read("temperature_index", TIMESERIES).count() == 2
    assert [r.current_temperature for r in store.read("enhanced_recommendations", RECOMMENDATIONS).orderBy("current_temperature").collect()] == [20.5, 21.5]


def test_lake_stream_reports_broken_documents_and_throttles(spark, base, landing):
    root, land, run = landing
    land("bad", "<html>busy</html>", "meals")
    t = 1704067200
    land(0, "\n".join([json.dumps(response(0, at=t)), "{oops", json.dumps(response(0, t=9.0, at=t + 119))]))
    store = run(spark)
    land(1, "\n".join([json.dumps(response(0, t=8.0, at=t + 119)), json.dumps(response(0, t=7.0, at=t + 120))]))
    run(spark)
    first, second = [r.report for r in store.marked().orderBy("batch").collect()]
    assert (first["broken"], second["broken"]) == ("2", "0")
    broken = store.read("landed", "kind string, file string, broken string").where("broken IS NOT NULL")
    assert sorted((r.kind, r.file, r.broken) for r in broken.collect()) == [("meals", "bad.json", "<html>busy</html>"), ("weather", "0.json", "{oops")]
    assert (first["raw_weather"], second["raw_weather"]) == ("1", "1")
    served = store.read("enhanced_recommendations", RECOMMENDATIONS).orderBy("@timestamp").collect()
    assert [r.current_temperature for r in served] == [20.5, 7.0] and served[0].suggested_meal is None


def test_index_reads_only_the_days_of_a_batch(spark, base):
    days = [("2024-01-01 00:00:00", 1.0), ("2024-01-02 00:00:00", 2.0), (None, 3.0)]
    df = spark.createDataFrame(days, "`@timestamp` string, v double")
    assert write_index(df, f"{base}/index") == 3 and write_index(df, f"{base}/index") == 0
    assert write_index(df.limit(1).withColumn("v", F.lit(5.0)), f"{base}/index") == 1
    kept = days_of(df.where("v = 1"))
    pruned = spark.read.schema("doc_id string, day string").parquet(f"{base}/index").where(kept(F.col("day")))
    scan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "day#" in scan and "2024-01-01" in scan.split("PartitionFilters")[1] and "2024-01-02" not in scan
    assert pruned.select("day").distinct().count() == 2
    assert days_of(df, most=1)(F.lit("x")) is not None and df.where(days_of(df, most=1)(F.col("@timestamp"))).count() == 3
