"""Operators against brute force on small inputs with the awkward cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skylarder import functions as fn
from skylarder import operators as op
from skylarder.operators import nearest, sizing


def nearest_model(t, entries):
    """Sort the lookup by distance, then by line, and take what comes first."""
    ranked = sorted((math.inf if math.isnan(t) else abs(k - t), line, advice) for line, (k, advice) in enumerate(entries)) if t is not None else []
    return ranked[0][2] if ranked else None


def lookup_of(spark, entries):
    rows = [(k, v, i) for i, (k, v) in enumerate(entries)]
    return spark.createDataFrame(rows, "k double, v string, pos int")


@pytest.mark.parametrize(("small", "few"), [(100_000, 64), (100_000, 2), (3, 2)])
def test_nearest_equals_brute_force(spark, monkeypatch, small, few):
    monkeypatch.setattr(nearest, "SMALL_KEYS", small)
    monkeypatch.setattr(nearest, "FEW_KEYS", few)
    rng = random.Random(5)
    crowded = [rng.randrange(1000) / 8 for _ in range(120)]
    for keys in (
        [20, 21, -3, 5, 20, 30, 5, 43],
        [7],
        [7, 7, 7],
        [0, 1000, 1001, 1002],
        crowded + [1e6],
        crowded + [-1e9, 500.0, 501.0],
    ):
        entries = [(float(k), f"advice {i}") for i, k in enumerate(rng.sample(keys, len(keys)))]
        temps = [None, 0.0, -0.5, 20.5, 12.5, 25.0, -1e6, 1e6, float("inf"), float("-inf"), float("nan")]
        temps += [rng.choice(keys) + rng.choice([-0.5, 0.0, 0.5, 1 / 16]) for _ in range(150)]
        temps += [rng.uniform(-50, 1100) for _ in range(100)]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(temps)], "i int, t double")
        got = op.nearest_join(df, lookup_of(spark, entries), "t", "k", "pos", "v", "out").collect()
        assert len(got) == len(temps)
        assert {r.i: r.out for r in got} == {i: nearest_model(t, entries) for i, t in enumerate(temps)}


def test_nearest_cuts_crowded_cells_again(spark):
    """With one key far out, all others share a cell; the join still tells them apart."""
    keys = spark.range(5000).select(F.col("id").cast("double").alias("k"))
    keys = keys.union(spark.sql("select 1e12D")).select("k", F.lit("v").alias("v"), F.col("k").alias("p"))
    seen = keys.agg(F.count("k").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).first()
    gaps = nearest._gaps(nearest._cells(keys, seen)(keys, F.col("k")), seen.n)
    per_cell = gaps.groupBy("__at_cell", "__at_part").count().agg(F.max("count")).first()[0]
    assert per_cell <= 3


@pytest.mark.parametrize("small", [100_000, 100])
@pytest.mark.parametrize("shape", ["two levels of outliers", "log spread"])
def test_nearest_cells_follow_the_keys(spark, monkeypatch, small, shape):
    """Cells hold a few gaps each wherever the keys lie, also where the lookup is large."""
    monkeypatch.setattr(nearest, "SMALL_KEYS", small)
    if shape == "log spread":
        keys = spark.range(20_000).select(F.exp(F.col("id") / 500).alias("k"))
    else:
        keys = spark.range(20_000).select((F.col("id") / 20_000).alias("k"))
        keys = keys.union(spark.sql("select explode(array(1e5D, 1e12D))"))
    keys = keys.select("k", F.lit("v").alias("v"), F.col("k").alias("p"))
    seen = keys.agg(F.count("k").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).first()
    gaps = nearest._gaps(nearest._cells(keys, seen)(keys, F.col("k")), seen.n)
    per_cell = gaps.groupBy("__at_cell", "__at_part").count().agg(F.max("count"), F.sum("count")).first()
    assert per_cell[0] <= 12 and per_cell[1] <= 4 * seen.n


def test_nearest_tie_goes_to_the_earlier_line_not_the_lower_key(spark):
    df = spark.createDataFrame([(20.5,)], "t double")
    for entries in ([(20.0, "a"), (21.0, "b")], [(21.0, "b"), (20.0, "a")]):
        out = op.nearest_join(df, lookup_of(spark, entries), "t", "k", "pos", "v", "out").first().out
        assert out == entries[0][1]


def test_nearest_empty_lookup_uses_fallback(spark):
    df = spark.createDataFrame([(5.0,), (None,)], "t double")
    out = op.nearest_join(
        df, lookup_of(spark, []), "t", "k", "pos", "v", "out", fallback=fn.fallback_advice
    )
    assert [r.out and r.out.split()[0] for r in out.collect()] == ["Perfect", None]


def test_position_within_spreads_a_hot_key_and_keeps_nulls(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.randrange(1000), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, at int, id int")
    out = op.position_within(df, order=[F.col("at"), F.col("id")], keys=["k"], total="n")
    want = {}
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        want |= {r[2]: (i, len(group)) for i, r in enumerate(group)}
    assert {r.id: (r.pos, r.n) for r in out.collect()} == want
    assert out.columns == ["k", "at", "id", "pos", "n"]


def test_random_pick_is_even_and_repeatable(spark):
    df = spark.range(20_000).withColumnRenamed("id", "key")
    choices = spark.range(10).select(F.col("id").alias("c"), (F.col("id") * 2).alias("twice"))
    one = op.random_pick(df, choices, "key", "c", seed="x")
    counts = {r["c"]: r["count"] for r in one.groupBy("pick.c").count().collect()}
    assert len(counts) == 10 and all(1800 < n < 2200 for n in counts.values())
    again = op.random_pick(df.repartition(5), choices.repartition(3), "key", "c", seed="x")
    assert sorted(one.collect()) == sorted(again.collect())
    other = op.random_pick(df, choices, "key", "c", seed="y")
    assert sorted(one.collect()) != sorted(other.collect())
    assert one.filter("pick.twice != pick.c * 2").count() == 0


def test_random_pick_without_choices(spark):
    none = op.random_pick(spark.range(3), spark.range(0).withColumnRenamed("id", "c"), "id", "c")
    assert [r.pick for r in none.collect()] == [None] * 3


def test_random_pick_is_the_same_beyond_the_broadcast_bound(spark, monkeypatch):
    df = spark.range(2000).withColumnRenamed("id", "key")
    choices = spark.range(300).select(F.col("id").alias("c"), F.lit("x").alias("v"))
    small = sorted(op.random_pick(df, choices, "key", "c").collect())
    monkeypatch.setattr(sizing, "MAX_ROWS", 299)
    large = op.random_pick(df, choices, "key", "c")
    # no hint over the choices; the starts of the sorted slices, one row a partition, may have one
    hinted = large._jdf.queryExecution().analyzed().toString().split("ResolvedHint")[1:]
    assert all(part.splitlines()[1].lstrip(" :+-|").startswith("Project [__slice#") for part in hinted)
    assert sorted(large.collect()) == small
    assert sizing.measure(choices) == (300, sum(len(f'{{"c":{i},"v":"x"}}') for i in range(300)))


def test_enrich_place_keeps_rows_one_to_one(spark):
    geo = spark.createDataFrame(
        [(1.0, 2.0, "A", None, "X"), (1.001, 2.0, "A", None, "X"), (3.0, 4.0, "", "T", None)],
        "lat double, lon double, city string, town string, country string",
    )
    df = spark.createDataFrame([(1, 1.002, 2.001), (2, 3.0, 4.0), (3, 9.0, 9.0), (4, None, 1.0)], "i int, a double, b double")
    got = {r.i: r.place for r in op.enrich_place(df, geo, "a", "b").collect()}
    assert got == {1: "A, X", 2: "T, Unknown", 3: "Unknown Location", 4: "Unknown Location"}


def test_dedup_first_drops_null_and_empty_ids(spark):
    df = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "early"), ("", 0, "x"), (None, 0, "y"), ("b", 5, "b")],
        "id string, at int, v string",
    )
    assert sorted(op.dedup_first(df, "id", ["at"]).collect()) == [("a", 1, "early"), ("b", 5, "b")]


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = op.dedup_first(spark.range(9).withColumn("k", F.col("id") % 2), "k", ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_latest_snapshot(spark):
    df = spark.createDataFrame(
        [("p", 1, "a"), ("p", 3, "b"), ("p", 3, "c"), (None, 2, "d"), (None, 1, "e"), ("q", None, "f")],
        "k string, at int, v string",
    )
    assert sorted(r.v for r in op.latest_snapshot(df, "at").collect()) == ["b", "c"]
    assert sorted(r.v for r in op.latest_snapshot(df, "at", ["k"]).collect()) == ["b", "c", "d"]
    assert op.latest_snapshot(df.limit(0), "at").collect() == []


def test_duplicate_report_and_examples(spark):
    rows = [(i, "2024", t, "zone") for i, t in enumerate([1.0, 2.0, 1.0, 3.0, 2.0, 1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "pos int, at string, t double, z string")
    df = df.withColumn("at", F.format_string("t%d", "pos"))
    body = df.select("at", "t", "z")
    assert op.duplicate_report(body, exclude=["at"]).collect() == [(9, 6, 3)]
    # with the time left in, nothing repeats
    assert op.duplicate_report(body).collect() == [(9, 0, 9)]
    found = op.duplicate_examples(df, at="at", order=["pos"], exclude=["pos"]).collect()
    assert [(r.times, r.first_times) for r in found] == [(6, ["t0", "t2", "t5", "t6", "t7"])]
    assert op.duplicate_report(body.limit(0)).collect() == [(0, 0, 0)]
    assert op.duplicate_examples(df.limit(1), at="at", order=["pos"], exclude=["pos"]).collect() == []


def test_renest_bounds_envelopes_and_keeps_every_row(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 900, "hot").alias("k"), F.col("id").alias("at"), (F.col("id") * 3).alias("v")
    )
    nested = op.renest(df, ["at", "v"], [F.col("at")], ["k"], max_items=64)
    rows = nested.collect()
    assert max(r.n for r in rows) == 64 and sum(r.n for r in rows) == 1000
    assert {r.total for r in rows if r.k == "hot"} == {900}
    hot = [i.at for r in sorted(rows, key=lambda r: r.part) if r.k == "hot" for i in r["items"]]
    assert hot == list(range(900))
    assert sorted(op.unnest(nested, "items", ["k"]).collect(), key=str) == sorted(df.collect(), key=str)
    assert op.count_check(nested, "items", "n").collect() == [(1000, 1000, True)]


def test_unnest_skips_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [(7,)])], "i int, a array<struct<x:int>>")
    assert op.unnest(df, "a", ["i"]).collect() == [(3, 7)]


def test_time_grid_and_zip(spark):
    df = spark.createDataFrame([(0, 10, 3), (5, 5, 1), (9, 5, 1), (0, 2, 5)], "a bigint, b bigint, s bigint")
    grid = op.time_grid(F.col("a"), F.col("b"), F.col("s"))
    assert [r[0] for r in df.select(grid).collect()] == [[0, 3, 6, 9], [], [], [0]]
    pairs = spark.createDataFrame([([1, 2, 3], ["a"]), ([1], ["a", "b"]), ([], ["a"])], "n array<int>, s array<string>")
    out = pairs.select(op.zip_short(F.col("n"), F.col("s"), ("x", "y")).alias("z")).collect()
    assert [r.z for r in out] == [[(1, "a")], [(1, "a")], []]


def test_empty_to_null_and_counts(spark):
    df = spark.createDataFrame([("", "x"), (" ", None), (None, "")], "a string, b string")
    cleaned = op.empty_to_null(df, "a", "b")
    assert cleaned.collect() == [(None, "x"), (" ", None), (None, None)]
    assert op.null_counts(cleaned, ["a", "b"]).collect() == [(3, 2, 2)]
    counted, seen = op.stage_count(cleaned, "clean")
    counted.collect()
    assert seen.get == {"rows": 3}


def test_storage_inventory_and_difference(spark, tmp_path):
    def put(path, size):
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(b"x" * size)

    put("lake/raw/a/b/one.json", 1000)
    put("lake/raw/two.json", 24)
    put("lake/usage/x.jsonl", 2048)
    before = op.storage_inventory(spark, str(tmp_path / "lake"))
    assert {r.layer: tuple(r)[1:] for r in before.collect()} == {
        "raw": (2, 2, 1024, "1.0 KB"),
        "usage": (1, 0, 2048, "2.0 KB"),
        None: (3, 2, 3072, "3.0 KB"),
    }
    after = before.filter("layer = 'raw'")
    diff = {r.layer: tuple(r)[1:] for r in op.inventory_diff(before, after).collect()}
    assert diff["raw"] == (0, 0, 0, "0.0 B")
    assert diff["usage"] == (1, 0, 2048, "2.0 KB")


def test_no_python_in_plans(spark, small_tables):
    """Only the throttle and the stream dedup run Python in tasks."""
    from skylarder.workload import QUERIES

    for name in ("recommend", "format_meals", "nearest_price", "timeseries", "normalise_weather"):
        plan = QUERIES[name](spark, small_tables)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan, name
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_scans_read_only_what_is_needed(spark, small_tables):
    from skylarder.workload import QUERIES

    def scans(name):
        plan = QUERIES[name](spark, small_tables)._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "FileScan" in line]

    assert not any("props" in line for line in scans("recommend"))
    assert not any("p_retailprice" in line for line in scans("recommend"))
    assert any("IsNotNull(p_size)" in line for line in scans("nearest_advice"))
    assert any("IsNotNull(user_id)" in line for line in scans("dedup_first"))
    assert all("text" not in line for line in scans("envelope_check"))
