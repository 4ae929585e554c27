"""A key with a third of all rows is split, and results stay whole."""

import contextlib

import pytest
from pyspark.sql import functions as F

from skylarder import operators as op
from skylarder.operators import nearest, sizing

ROWS = 200_000


@contextlib.contextmanager
def settings(spark, **conf):
    names = {
        "partitions": "spark.sql.shuffle.partitions",
        "threshold": "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "target": "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "broadcast": "spark.sql.autoBroadcastJoinThreshold",
        "late_broadcast": "spark.sql.adaptive.autoBroadcastJoinThreshold",
        "merge_small": "spark.sql.adaptive.coalescePartitions.enabled",
    }
    before = {names[k]: spark.conf.get(names[k], None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(names[k], v)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def shuffled(spark):
    # joins shuffle, and the bounds of a skewed partition are those of a small test
    with settings(spark, partitions="64", threshold="64k", target="32k", broadcast="-1", late_broadcast="-1"):
        yield


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def hot_rows(spark):
    """A third of the rows share key 1, the others are spread out."""
    key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.pmod(F.xxhash64("id"), F.lit(20_000)))
    return spark.range(0, ROWS, 1, 16).select(
        "id", key.cast("bigint").alias("key"), F.timestamp_seconds(F.col("id")).alias("at")
    )


def test_places_with_a_hot_position(spark, shuffled):
    rows = hot_rows(spark).select("id", (F.col("key") / 10).alias("a"), F.lit(1.0).alias("b"))
    geo = spark.range(20_000).select(
        (F.col("id") / 10).alias("lat"),
        F.lit(1.0).alias("lon"),
        F.concat(F.lit("c"), F.col("id")).alias("city"),
        F.lit(None).cast("string").alias("town"),
        F.lit("X").alias("country"),
    )
    named = op.enrich_place(rows, geo, "a", "b").select("id", "place")
    assert "skew=true" in final_plan(named)
    assert named.count() == ROWS and named.filter("place = 'Unknown Location'").count() == 0


def test_nearest_with_a_hot_value_and_a_large_lookup(spark, shuffled, monkeypatch):
    monkeypatch.setattr(nearest, "SMALL_KEYS", 100)
    rows = hot_rows(spark).select("id", (F.col("key") + 0.25).alias("v"))
    lookup = spark.range(20_000).select(
        F.col("id").alias("k"), F.col("id").cast("string").alias("text"), F.col("id").alias("p")
    )
    found = op.nearest_join(rows, lookup, "v", "k", "p", "text", "got")
    assert "skew=true" in final_plan(found)
    assert found.count() == ROWS
    assert found.filter(F.col("got") != F.floor("v").cast("string")).count() == 0


def test_pick_with_a_hot_key_and_many_choices(spark, shuffled, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_ROWS", 100)
    choices = spark.range(20_000).select(F.col("id").alias("c"))
    picked = op.random_pick(hot_rows(spark), choices, "key", "c")
    assert "skew=true" in final_plan(picked)
    assert picked.filter("pick is null").count() == 0
    assert picked.filter("key = 1").select("pick.c").distinct().count() == 1


def test_latest_with_a_hot_snapshot(spark, shuffled):
    rows = hot_rows(spark).withColumn("at", F.when(F.col("key") == 1, F.lit(7)).otherwise(F.col("id")))
    latest = op.latest_snapshot(rows, "at", ["key"])
    assert "skew=true" in final_plan(latest)
    hot = rows.filter("key = 1").count()
    assert latest.filter("key = 1").count() == hot
    assert latest.count() == hot + rows.filter("key != 1").select("key").distinct().count()


def test_numbering_and_dedup_with_a_hot_key(spark):
    rows = hot_rows(spark)
    placed = op.position_within(rows, [F.col("at")], ["key"], total="n")
    hot = placed.filter("key = 1").agg(F.count("*"), F.countDistinct("pos"), F.max("pos"), F.max("n")).first()
    assert hot[0] == hot[1] == hot[2] + 1 == hot[3]
    assert op.dedup_first(rows, "key", ["at"]).count() == rows.select("key").distinct().count()


def test_numbering_slices_a_key_whose_rows_share_a_day(spark, monkeypatch, tmp_path):
    """A third of the rows are one key on one day; no task sorts more than about its part."""
    from skylarder.operators import numbering

    monkeypatch.setattr(numbering, "shared_dir", lambda *_: str(tmp_path / "sorted"))
    with settings(spark, partitions="16", merge_small="false"):
        placed = op.position_within(hot_rows(spark), [F.to_date("at"), F.col("id")], ["key"])
    written = spark.read.parquet(str(tmp_path / "sorted"))
    slices = written.groupBy(F.shiftright("__row", 33)).count().agg(F.count("*"), F.max("count"), F.sum("count")).first()
    assert slices[0] >= 8 and slices[1] <= 2 * ROWS / slices[0] and slices[2] == ROWS
    hot = placed.filter("key = 1").agg(F.count("*"), F.countDistinct("pos"), F.max("pos"), F.min("pos")).first()
    assert hot[0] == hot[1] == hot[2] + 1 and hot[3] == 0
