"""As-of joins against a plain loop, over keys, ties, borders between tasks, and whole histories."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skylarder.operators import asof_join
from skylarder.plans import recommend, recommend_history
from skylarder.workload import inputs

START = datetime(2030, 5, 1)


def plain(lefts, rights, keyed=True):
    """Per left row the last right row at or before it."""
    out = {}
    for i, k, t in lefts:
        known = t is not None and (k is not None or not keyed)
        before = [r for r in rights if known and r[2] is not None and r[2] <= t and (not keyed or r[1] == k)]
        out[i] = max(before, key=lambda r: (r[2], r[0]))[0] if before else None
    return out


def series(rng, n, keys, span):
    return [(i, rng.choice(keys), rng.choice([START + timedelta(seconds=rng.randrange(span))] * 30 + [None])) for i in range(n)]


@pytest.mark.parametrize(("keyed", "partitions", "batch"), [(True, 8, 10_000), (True, 64, 7), (False, 16, 10_000), (False, 3, 5)])
def test_equals_plain_loop(spark, keyed, partitions, batch):
    rng = random.Random(partitions)
    lefts = series(rng, 700, ["hot"] * 6 + ["a", "", None], 900)
    rights = series(rng, 150, ["hot"] * 6 + ["a", "", None, "only right"], 900)
    left = spark.createDataFrame(lefts, "i long, k string, t timestamp").repartition(5)
    right = spark.createDataFrame(rights, "i long, k2 string, t timestamp")
    before = {n: spark.conf.get(n) for n in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = asof_join(left, right, "t", "t", [("k", "k2")] if keyed else [], ["i"], "r")
        assert got.columns == ["i", "k", "t", "r"]
        rows = got.collect()
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(rows) == len(lefts)
    assert {r.i: r.r and r.r.i for r in rows} == plain(lefts, rights, keyed)


def test_right_row_far_before_many_tasks_of_left_rows(spark):
    """One early right row, and left rows over many tasks that hold no right row at all."""
    left = spark.range(20_000).select("id", F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") + 10).alias("t"))
    right = spark.createDataFrame([("k", START.replace(year=1970, month=1, day=1), {"deep": [1, 2]}), ("j", START, None)], "k string, u timestamp, v struct<deep: array<int>>")
    got = asof_join(left, right, "t", "u", [("k", "k")])
    assert got.where("match.v.deep[1] = 2").count() == 20_000
    assert asof_join(left, right.limit(0), "t", "u", [("k", "k")]).where("match IS NULL").count() == 20_000
    assert asof_join(left.limit(0), right, "t", "u", [("k", "k")]).count() == 0


def test_a_hot_key_spreads(spark, tmp_path, monkeypatch):
    from skylarder.operators import asof

    monkeypatch.setattr(asof, "shared_dir", lambda *_: str(tmp_path / "met"))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(0, 60_000, 1, 8).select("id", F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") % 100).alias("t"))
        right = spark.range(50).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 2).alias("t"), "id")
        got = asof_join(left, right, "t", "t", [("k", "k")])
        assert got.where("match.id = (unix_seconds(t) - unix_seconds(t) % 2) / 2").count() == 60_000
    finally:
        spark.conf.set(merge, "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    slices = spark.read.parquet(str(tmp_path / "met")).groupBy("slice").count().agg(F.count("*"), F.max("count")).first()
    assert slices[0] >= 12 and slices[1] <= 2 * 60_000 / slices[0]


def test_history_with_one_menu_is_the_plain_recommendation(spark, small_tables):
    weather = inputs.observations(inputs.table(spark, small_tables, "events"), inputs.table(spark, small_tables, "customer"))
    meals, advice = inputs.menu(spark, small_tables), inputs.advice(spark, small_tables)
    old = meals.withColumn("snapshot_at", F.lit(datetime(2001, 1, 1)))
    late = meals.limit(3).withColumn("snapshot_at", F.lit(datetime(2101, 1, 1)))
    gone = meals.limit(3).withColumn("snapshot_at", F.lit(None).cast("timestamp"))
    got = recommend_history(weather, old.unionByName(late).unionByName(gone), advice, key="event_id", seed="x")
    want = recommend(weather, meals, advice, key="event_id", seed="x")
    assert got.columns == want.columns and got.count() == want.count() and got.exceptAll(want).count() == 0
    none = recommend_history(weather, late, advice, key="event_id")
    assert none.count() == want.count() and none.where("suggested_meal IS NOT NULL OR preparation_time IS NOT NULL").count() == 0
