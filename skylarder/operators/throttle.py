"""Keep a reading only if the last kept one of its key is old enough."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylarder.operators.numbering import position_within
from skylarder.session import shared_dir

BLOCK_GAPS = 30
#: rows a block holds at most; a denser stretch of time is cut by rows
BLOCK_ROWS = 65_536
#: neighbouring blocks of a key that meet in one task
FAN = 64
# a block of time of one key, and a run of FAN of them
GROUP = ["void", "k", "block"]
RUN = ["void", "k", "run"]
# stands for "no time"; sorts before every time
NONE = -(2**62)


def throttle(
    df: DataFrame,
    key: str,
    at: str,
    gap_seconds: float,
    row_id: str,
    last_kept: DataFrame | None = None,
    block_gaps: int = BLOCK_GAPS,
    block_rows: int = BLOCK_ROWS,
    fan: int = FAN,
) -> DataFrame:
    """Per key, in time order, skip rows younger than the gap since the last kept row.

    ``row_id`` is unique; among rows of the same instant the lowest one stands.
    ``last_kept`` (columns key and ``at``) carries the outcome of earlier data; rows
    less than a gap after it, or before it, are skipped.

    Which rows are kept depends on all earlier ones, but a block of rows depends on its
    past only through one number, the last kept time before it. So a key's rows are cut
    into blocks of ``block_gaps`` gaps, and of ``block_rows`` rows where they are dense:

    1. each block, in parallel, maps every possible last kept time to the last kept time
       at its end (a short step function);
    2. step functions compose, so runs of ``fan`` neighbouring blocks become one function
       each, runs of runs again, until a key has at most ``fan``. The last kept time is
       then passed down the same tree: each run tells its blocks what reaches them;
    3. each block, in parallel, is walked from its incoming time.

    What meets in one task is a block's rows or a run's functions, whatever the share of
    a key. A function has at most as many steps as its first gap has rows.
    """
    gap = round(gap_seconds * 1_000_000)
    if gap <= 0:
        raise ValueError("gap_seconds must be above 0; without a gap every instant is kept")
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    kind, label = _label(df, key)
    rows = df.select(*label, micros.alias("t"), F.col(row_id).alias("id")).filter("t is not null")
    if last_kept is not None:
        earlier = last_kept.select(*label, micros.alias("last")).groupBy("void", "k")
        rows = rows.join(earlier.agg(F.max("last").alias("last")), ["void", "k"], "left")
        rows = rows.filter(F.col("last").isNull() | (F.col("t") - F.col("last") >= gap))
    # rows of the same instant are reduced before the shuffle
    ticks = (
        rows.groupBy("void", "k", "t")
        .agg(F.min("id").alias("id"))
        .withColumn("block", F.floor(F.col("t") / F.lit(gap * block_gaps)))
    )

    ticks, low, high = _cut(ticks, block_rows)

    group = f"void boolean, k {kind}, block bigint"
    # with the same columns as below, so that the shuffled ticks are used twice
    steps = _sorted_groups(ticks.select(*GROUP, "t", "id"), "t").mapInPandas(
        lambda frames: (_block_steps(f, gap) for f in _whole_groups(frames)),
        f"{group}, opens bigint, upto bigint, leaves bigint",
    )
    incoming = _incoming(steps, gap, low, high, fan)

    # the incoming time travels as the first row of its block
    id_kind = ticks.schema["id"].dataType
    blocks = ticks.select(*GROUP, "t", F.lit(NONE).alias("last"), "id").union(
        incoming.select(*GROUP, F.lit(NONE).alias("t"), "last", F.lit(0).cast(id_kind))
    )
    kept = _sorted_groups(blocks, "t").mapInPandas(
        lambda frames: (_walk(f, gap) for f in _whole_groups(frames)),
        f"__kept {id_kind.simpleString()}",
    )
    return df.join(kept, F.col(row_id) == F.col("__kept"), "left_semi")


def _cut(ticks: DataFrame, block_rows: int) -> tuple[DataFrame, int, int]:
    """Ticks in blocks of at most ``block_rows``, and the lowest and highest block."""
    spark, path = ticks.sparkSession, shared_dir(ticks.sparkSession, "ticks")
    ticks.write.parquet(path)
    ticks = spark.read.schema(ticks.schema).parquet(path)
    rows = ticks.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"))
    seen = rows.agg(F.max("n").alias("n"), F.min("block").alias("low"), F.max("block").alias("high")).first()
    if seen.n is None or seen.n <= block_rows:
        return ticks, seen.low or 0, seen.high or 0
    parts = -(-seen.n // block_rows)
    placed = position_within(ticks, [F.col("t")], GROUP, name="place")
    number = F.col("block") * parts + F.floor(F.col("place") / block_rows)
    return placed.withColumn("block", number).drop("place"), seen.low * parts, (seen.high + 1) * parts - 1


def _incoming(steps: DataFrame, gap: int, low: int, high: int, fan: int) -> DataFrame:
    """void, k, block, last: the last kept time that reaches each block."""
    spark, kind = steps.sparkSession, steps.schema["k"].dataType.simpleString()
    levels = [steps]
    if high - low >= fan:
        base = shared_dir(spark, "steps")
        while high - low >= fan:
            # read twice, on the way up and on the way down
            levels[-1].write.parquet(f"{base}/{len(levels)}")
            levels[-1] = spark.read.schema(steps.schema).parquet(f"{base}/{len(levels)}")
            composed = _runs(levels[-1].withColumn("run", F.floor(F.col("block") / fan))).mapInPandas(
                lambda frames: (_compose(f, gap) for f in _whole_groups(frames, RUN)), steps.schema
            )
            levels.append(composed)
            low, high = low // fan, high // fan
    last = None
    for level in reversed(levels):
        # the whole of a key is one run at the top
        run = F.lit(0).cast("bigint") if last is None else F.floor(F.col("block") / fan)
        rows = level.withColumns({"run": run, "last": F.lit(NONE)})
        if last is not None:
            # what reaches a run, in a row ahead of its blocks
            none = [F.lit(NONE).alias(c) for c in ("block", "opens", "upto", "leaves")]
            rows = rows.unionByName(last.select("void", "k", *none, F.col("block").alias("run"), "last"))
        last = _runs(rows).mapInPandas(
            lambda frames: (_follow(f, gap) for f in _whole_groups(frames, RUN)),
            f"void boolean, k {kind}, block bigint, last bigint",
        )
    return last


def _sorted_groups(df: DataFrame, order: str) -> DataFrame:
    return df.repartition(*GROUP).sortWithinPartitions(*GROUP, order)


def _runs(steps: DataFrame) -> DataFrame:
    return steps.repartition(*RUN).sortWithinPartitions(*RUN, "block", "upto")


def _label(df: DataFrame, key: str) -> tuple[str, list[Column]]:
    """A key of any type as a number or a text without nulls, and whether it is null."""
    value = F.col(key)
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    kind, blank = ("bigint", F.lit(0)) if whole else ("string", F.lit(""))
    label = F.coalesce(value.cast(kind), blank).cast(kind)
    return kind, [value.isNull().alias("void"), label.alias("k")]


def _starts(frame: pd.DataFrame, by: list[str] = GROUP) -> np.ndarray:
    """Whether each row opens a group."""
    first = np.zeros(len(frame), dtype=bool)
    if len(frame):
        first[0] = True
    for name in by:
        column = frame[name].to_numpy()
        first[1:] |= column[1:] != column[:-1]
    return first


def _whole_groups(frames: Iterable[pd.DataFrame], by: list[str] = GROUP) -> Iterator[pd.DataFrame]:
    """Regroup the sorted batches of a partition so that no group spans two of them."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if frame.empty:
            continue
        if held:
            tail, head = held[-1].iloc[-1], frame.iloc[0]
            if any(tail[name] != head[name] for name in by):
                yield pd.concat(held, ignore_index=True)
                held = []
        opens = int(np.flatnonzero(_starts(frame, by))[-1])
        if opens:
            yield pd.concat([*held, frame.iloc[:opens]], ignore_index=True)
            held = []
        held.append(frame.iloc[opens:])
    if held:
        yield pd.concat(held, ignore_index=True)


def _hops(t: np.ndarray, first: np.ndarray, gap: int):
    """Group of each row, time since its group began, and the row kept after it.

    A row without a follower in its group points to itself.
    """
    starts = np.flatnonzero(first)
    group = np.cumsum(first) - 1
    since = t - t[starts][group]
    # lay the groups out on one axis, more than a gap apart
    axis = since + group * (int(since.max()) + gap + 1)
    target = np.searchsorted(axis, axis + gap)
    inside = target < len(t)
    inside[inside] = group[target[inside]] == group[inside]
    return group, since, np.where(inside, target, np.arange(len(t)))


def _block_steps(frame: pd.DataFrame, gap: int) -> pd.DataFrame:
    """For each block: a first kept time up to ``upto`` leaves ``leaves`` as the last one."""
    t, first = frame["t"].to_numpy(), _starts(frame)
    group, since, hop = _hops(t, first, gap)
    end = hop
    while not np.array_equal(end, further := end[end]):
        end = further
    # times before the block reach less than a gap into it, or the next row after that
    entry = since < gap
    entry[hop[first]] = True
    rows = np.flatnonzero(entry)
    change = np.ones(len(rows), dtype=bool)
    change[:-1] = (end[rows[1:]] != end[rows[:-1]]) | (group[rows[1:]] != group[rows[:-1]])
    rows = rows[change]
    steps = frame.iloc[rows][GROUP].reset_index(drop=True)
    opens = t[first][group[rows]]
    return steps.assign(opens=opens, upto=t[rows], leaves=t[end[rows]])


def _after(f: tuple[np.ndarray, np.ndarray], last: np.ndarray, gap: int) -> np.ndarray:
    """The last kept time after a step function, for each last kept time before it."""
    upto, leaves = f
    step = np.searchsorted(upto, last + gap)
    return np.where(step < len(upto), leaves[np.minimum(step, len(upto) - 1)], last)


def _then(f, g, opens: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """One step function for ``f`` and, after it, ``g``; the rows of ``f`` begin at ``opens``."""
    upto, leaves = f[0], _after(g, f[1], gap)
    # times that pass over all of f meet g, but lie before ``opens``
    rest = np.flatnonzero(g[0] > upto[-1])
    if upto[-1] < opens + gap:
        rest = rest[: np.searchsorted(g[0][rest], opens + gap) + 1]
        upto, leaves = np.append(upto, g[0][rest]), np.append(leaves, g[1][rest])
    change = np.append(leaves[1:] != leaves[:-1], True)
    return upto[change], leaves[change]


def _compose(frame: pd.DataFrame, gap: int) -> pd.DataFrame:
    """For each run of blocks: their step functions as one."""
    begins = np.append(np.flatnonzero(_starts(frame, [*RUN, "block"])), len(frame))
    runs = np.append(np.flatnonzero(_starts(frame, RUN)), len(frame))
    first = np.searchsorted(begins, runs)
    opens, upto, leaves = (frame[c].to_numpy() for c in ("opens", "upto", "leaves"))
    found = []
    for r, (a, b) in enumerate(zip(first[:-1], first[1:])):
        start = begins[a]
        f = upto[start : begins[a + 1]], leaves[start : begins[a + 1]]
        for i in range(a + 1, b):
            f = _then(f, (upto[begins[i] : begins[i + 1]], leaves[begins[i] : begins[i + 1]]), opens[start], gap)
        found.append((runs[r], f))
    sizes = [len(f[0]) for _, f in found]
    heads = frame.iloc[np.repeat([at for at, _ in found], sizes)][[*RUN, "opens"]].reset_index(drop=True)
    steps = heads.rename(columns={"run": "block"})
    return steps.assign(upto=np.concatenate([f[0] for _, f in found]), leaves=np.concatenate([f[1] for _, f in found]))


def _follow(frame: pd.DataFrame, gap: int) -> pd.DataFrame:
    """The last kept time before each block of a run, from what reaches the run.

    That comes in a row without steps, ahead of the run's blocks; without one nothing
    came before. A block that opens a gap or more after every outcome of the block before
    it starts afresh; only the others are followed one by one.
    """
    told = frame["upto"].to_numpy() == NONE
    run = np.cumsum(_starts(frame, RUN)) - 1
    reaching = np.full(run[-1] + 1, NONE)
    reaching[run[told]] = frame["last"].to_numpy()[told]
    rows, run = frame[~told], run[~told]
    starts = np.flatnonzero(_starts(rows, [*RUN, "block"]))
    stops = np.append(starts[1:], len(rows))
    opens, upto, leaves = (rows[c].to_numpy() for c in ("opens", "upto", "leaves"))
    opens, run = opens[starts], run[starts]
    latest = np.maximum.reduceat(leaves, starts)
    before = np.where(np.append(True, run[1:] != run[:-1]), reaching[run], NONE)
    linked = np.append(False, (run[1:] == run[:-1]) & (opens[1:] - latest[:-1] < gap))
    after = leaves[starts]
    for i in np.flatnonzero(linked | (before != NONE)):
        if linked[i]:
            before[i] = after[i - 1]
        after[i] = _after((upto[starts[i] : stops[i]], leaves[starts[i] : stops[i]]), before[i], gap)
    return rows.iloc[starts][GROUP].assign(last=before)


def _walk(frame: pd.DataFrame, gap: int) -> pd.DataFrame:
    """The rows kept in each block, from the incoming time in its first row."""
    head = _starts(frame)
    last = frame["last"].to_numpy()[head]
    first = np.roll(head, 1)[~head]
    rows = frame[~head]
    t = rows["t"].to_numpy()
    group, _, hop = _hops(t, first, gap)
    earliest = np.where(last == NONE, t[first], last + gap)
    eligible = np.flatnonzero(t >= earliest[group])
    _, opening = np.unique(group[eligible], return_index=True)
    at = eligible[opening]
    kept = np.zeros(len(t), dtype=bool)
    while len(at):
        kept[at] = True
        at = hop[at][hop[at] != at]
    return rows.loc[kept, ["id"]].rename(columns={"id": "__kept"})
