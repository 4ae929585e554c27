"""Throttling against a plain loop, across keys, densities, block and batch sizes."""

import importlib
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skylarder.operators import throttle

steps = importlib.import_module("skylarder.operators.throttle")

START = datetime(2024, 1, 1)


def greedy(rows, gap, last=None):
    kept, last = [], dict(last or {})
    for row_id, key, at in sorted(rows, key=lambda r: (r[2], r[0])):
        if key not in last or (at - last[key]).total_seconds() >= gap:
            last[key] = at
            kept.append(row_id)
    return sorted(kept), last


def sample(seed, n, span_seconds, resolution=1.0):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "", None]
    steps = int(span_seconds / resolution)
    return [
        (i, rng.choice(keys), START + timedelta(seconds=rng.randrange(steps) * resolution))
        for i in range(n)
    ]


def run(spark, rows, gap, **options):
    df = spark.createDataFrame(rows, "id bigint, key string, at timestamp").repartition(3)
    return sorted(r.id for r in throttle(df, "key", "at", gap, "id", **options).collect())


@pytest.mark.parametrize(
    ("n", "span", "resolution", "gap", "block_gaps", "block_rows", "fan"),
    [
        (3000, 36_000, 1.0, 120, 30, 65_536, 64),  # dense: chains never break
        (3000, 36_000, 0.001, 120, 3, 65_536, 4),
        (400, 400_000, 1.0, 120, 5, 65_536, 8),  # sparse: mostly alone
        (2000, 2_000, 1.0, 7, 1, 50, 3),  # blocks as short as the gap
        (500, 100, 1.0, 120, 30, 16, 2),  # everything within one gap, cut by rows
        (3000, 36_000, 1.0, 600, 10, 40, 2),
    ],
)
def test_equals_greedy_loop(spark, n, span, resolution, gap, block_gaps, block_rows, fan):
    rows = sample(n + gap, n, span, resolution)
    got = run(spark, rows, gap, block_gaps=block_gaps, block_rows=block_rows, fan=fan)
    assert got == greedy(rows, gap)[0]


def solve(times, blocks, gap, fan, batch):
    """The three steps for one key, as the tasks run them, without Spark."""
    rows = pd.DataFrame({"void": False, "k": 1, "block": blocks, "t": times})

    def cut(frame):
        return [frame.iloc[i : i + batch].reset_index(drop=True) for i in range(0, len(frame), batch)]

    def in_runs(work, frame, run):
        frame = frame.assign(run=run).sort_values(["run", "block", "upto"])
        return pd.concat([work(f, gap) for f in steps._whole_groups(cut(frame), steps.RUN)], ignore_index=True)

    levels = [pd.concat([steps._block_steps(f, gap) for f in steps._whole_groups(cut(rows))])]
    while levels[-1].block.max() - levels[-1].block.min() >= fan:
        levels.append(in_runs(steps._compose, levels[-1], levels[-1].block // fan))
    last = None
    for level in reversed(levels):
        if last is None:
            last = in_runs(steps._follow, level.assign(last=steps.NONE), 0)
            continue
        told = last.assign(run=last.block, block=steps.NONE, opens=steps.NONE, upto=steps.NONE, leaves=steps.NONE)
        both = pd.concat([level.assign(last=steps.NONE, run=level.block // fan), told])
        last = in_runs(steps._follow, both, both.run)
    marked = pd.concat([rows.assign(last=steps.NONE, id=rows["t"]), last.assign(t=steps.NONE, id=0)])
    marked = marked.sort_values(["block", "t"])
    return sorted(pd.concat([steps._walk(f, gap) for f in steps._whole_groups(cut(marked))])["__kept"])


@given(
    st.lists(st.integers(-150, 300), min_size=1, max_size=120, unique=True),
    st.integers(1, 40),
    st.integers(1, 5),
    st.integers(2, 4),
    st.integers(1, 6),
    st.integers(1, 50),
)
@settings(max_examples=150, deadline=None)
def test_steps_equal_greedy_loop(times, gap, gaps_per_block, fan, rows_per_block, batch):
    kept, at = [], None
    times = sorted(times)
    for t in times:
        if at is None or t - at >= gap:
            kept.append(t)
            at = t
    by_time = np.array(times) // (gap * gaps_per_block)
    by_rows = np.arange(len(times)) // rows_per_block - 3
    assert solve(times, by_time, gap, fan, batch) == kept
    assert solve(times, by_rows, gap, fan, batch) == kept


def test_whole_number_keys_and_text_ids(spark):
    rows = [(f"{i:05}", None if k == "b" else len(k or ""), at) for i, k, at in sample(12, 1500, 20_000)]
    df = spark.createDataFrame(rows, "id string, key int, at timestamp")
    assert sorted(r.id for r in throttle(df, "key", "at", 120, "id").collect()) == greedy(rows, 120)[0]


def test_groups_that_span_batches(spark):
    rows = sample(9, 2000, 20_000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        assert run(spark, rows, 120) == greedy(rows, 120)[0]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_exact_age_is_kept_and_ties_take_lowest_id(spark):
    at = [START + timedelta(seconds=s) for s in (0, 0, 119.999999, 120, 239, 240)]
    rows = [(i, "k", t) for i, t in zip([5, 2, 1, 7, 8, 9], at)]
    assert run(spark, rows, 120) == [2, 7, 9]


def test_earlier_outcome_carries_over(spark):
    rows = sample(11, 2500, 30_000)
    cut = START + timedelta(seconds=14_321)
    early, late = [r for r in rows if r[2] < cut], [r for r in rows if r[2] >= cut]
    _, last = greedy(early, 120)
    state = spark.createDataFrame(list(last.items()), "key string, at timestamp")
    assert run(spark, late, 120, last_kept=state) == greedy(late, 120, last)[0]


def test_rows_older_than_the_last_kept_are_skipped(spark):
    state = spark.createDataFrame([("k", START)], "key string, at timestamp")
    seconds = [-18_000, -60, 0, 30, 119, 120, 200, 239, 241, 400]
    rows = [(i, "k", START + timedelta(seconds=s)) for i, s in enumerate(seconds)]
    assert run(spark, rows + [(99, None, START)], 120, last_kept=state) == [5, 8, 9, 99]


def test_a_dense_key_loads_no_task(spark, monkeypatch):
    """One key, evenly spaced: no block, no run of step functions holds a large share of the rows."""
    n, blocks, runs = 120_000, [], []
    groups, into_runs = steps._sorted_groups, steps._runs
    monkeypatch.setattr(steps, "_sorted_groups", lambda df, order: blocks.append(df) or groups(df, order))
    monkeypatch.setattr(steps, "_runs", lambda df: runs.append(df) or into_runs(df))
    df = spark.range(n).select("id", F.lit("hot").alias("key"), F.timestamp_seconds(F.col("id")).alias("at"))
    kept = throttle(df, "key", "at", 7, "id", block_rows=1000, fan=8)
    assert sorted(r.id for r in kept.collect()) == list(range(0, n, 7))
    assert len(runs) > 4  # levels up and down
    largest = [df.groupBy(*by).count().agg(F.max("count")).first()[0] for by, dfs in ((steps.GROUP, blocks), (steps.RUN, runs)) for df in dfs]
    assert max(largest) <= 1100


def test_blocks_far_apart_and_an_empty_table(spark):
    rows = [(i, "k", START + timedelta(days=400 * i, seconds=s)) for i, s in enumerate((0, 1, 2))]
    assert run(spark, rows, 1, fan=16) == [0, 1, 2]
    empty = spark.createDataFrame([], "id bigint, key string, at timestamp")
    assert throttle(empty, "key", "at", 5, "id").count() == 0
