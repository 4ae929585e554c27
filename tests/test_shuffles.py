"""Whole rows are shuffled no more often than the job asks for."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from skylarder import plans
from skylarder.operators import pick
from skylarder.operators.numbering import position_within
from skylarder.schemas import MEAL_SHARD

AT = datetime(2031, 2, 3, 4, 5, 6)


def meal(id, name):
    return {"idMeal": id, "strMeal": name}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbering_sends_few_keys_to_the_rows(spark):
    rows = spark.range(2000).withColumn("k", F.col("id") % 7)
    numbered = position_within(rows, [F.col("id")], ["k"])
    assert "SortMergeJoin" not in plan_of(numbered) and "ShuffledHashJoin" not in plan_of(numbered)
    assert numbered.where("pos <> floor(id / 7)").isEmpty() and numbered.count() == 2000


def test_landing_shuffles_whole_meals_once(spark):
    shards = spark.createDataFrame([("a", [meal("1", "x")]), ("b", [meal("1", "y"), meal("2", "z")])], f"shard string, {MEAL_SHARD}")
    exchanges = [x for x in plan_of(plans.land_meals(shards, AT)).split("\n") if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 2, exchanges  # ids and places, then whole meals to their shard


def test_landing_over_repeated_and_null_shards_and_seen_ids(spark):
    rows = [
        ("a", [meal("1", "x"), meal("2", "p")]),
        ("a", [meal("1", "x"), meal("3", "q"), meal("9", "r")]),
        (None, [meal("2", "first, null shards sort first"), meal("4", "s")]),
    ]
    shards = spark.createDataFrame(rows, f"shard string, {MEAL_SHARD}")
    landed = lambda **k: sorted([(m.idMeal, m.strMeal) for m in r.meals] for r in plans.land_meals(shards, AT, **k).collect())
    null_shard = [("2", "first, null shards sort first"), ("4", "s")]
    assert landed() == [[("1", "x"), ("3", "q"), ("9", "r")], null_shard]
    seen = spark.createDataFrame([("1",), ("4",)], "id string")
    assert landed(seen=seen) == [null_shard[:1], [("3", "q"), ("9", "r")]]


def test_stored_shards_keep_whole_meals_in_place(spark):
    rows = [
        ("a", [meal("1", "x"), None, meal(None, "no id"), meal("2", "p"), meal("2", "again")]),
        ("b", [meal("1", "y")]),
        ("c", [meal("5", "whole"), meal("6", "whole")]),
        ("d", None),
        ("e", []),
        ("f", [meal("", "empty"), meal("9", "seen"), meal("7", "z"), meal("6", "later")]),
    ]
    shards = spark.createDataFrame(rows, f"shard string, {MEAL_SHARD}")
    seen = spark.createDataFrame([("9",)], "id string")

    def landed(**k):
        found = plans.land_meals(shards, AT, seen=seen, **k)
        return found.schema.simpleString(), sorted((r.total_meals, [(m.idMeal, m.strMeal) for m in r.meals]) for r in found.collect())

    assert landed(stored=True) == landed()
    assert landed(stored=True)[1] == [(1, [("7", "z")]), (2, [("1", "x"), ("2", "p")]), (2, [("5", "whole"), ("6", "whole")])]
    exchanges = [x for x in plan_of(plans.land_meals(shards, AT, stored=True)).split("\n") if "Exchange" in x]
    names = [x for x in exchanges if "strMeal" in x]
    assert not names, names


def test_stored_documents_shuffle_repeated_ids_only(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n"), (None, "n"), (3, "c")], "k int, v string")
    docs = lambda **how: sorted(plans.index_docs(rows, None, F.col("k"), **how).select("doc_id", "v").collect(), key=str)
    assert docs(stored=True) == docs() and len(docs()) == 4
    monkeypatch.setattr("skylarder.plans.index.fits", lambda n, size: False)
    assert docs(stored=True) == docs()


def test_many_choices_are_numbered_by_key_alone(spark, monkeypatch):
    rows = spark.range(500).select(F.col("id").alias("k"))
    choices = spark.range(40).select("id", F.concat(F.lit("text "), "id").alias("text"))
    few = {r.k: r.pick.text for r in pick.random_pick(rows, choices, "k", "id").collect()}
    numbered = []
    monkeypatch.setattr(pick, "fits", lambda n, size: False)
    monkeypatch.setattr(pick, "position_within", lambda df, *a, **k: numbered.append(df.columns) or position_within(df, *a, **k))
    assert {r.k: r.pick.text for r in pick.random_pick(rows, choices, "k", "id").collect()} == few
    assert numbered == [["__met"]]
    # keys that repeat are choices of their own
    twice = pick.random_pick(rows, choices.union(choices), "k", "id")
    assert twice.where("pick.text IS NULL").isEmpty() and twice.count() == 500 and len(numbered[1]) == 2
