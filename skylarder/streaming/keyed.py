"""Streams that remember something per key in the state store.

The state lives in RocksDB: a batch reads and writes the state of its own keys only,
whatever has been seen before. A batch's rows of one key meet in one task; bound a batch
with ``maxBytesPerTrigger``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State in RocksDB, changes checkpointed instead of whole snapshots; stateful Python operators need it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _named(frame: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    """Under their own names; names that no Python attribute may have arrive as numbers."""
    return frame.set_axis(columns, axis=1)


class LastKept(StatefulProcessor):
    """Keeps a row if it is a gap or more after the last kept one of its key."""

    def __init__(self, gap: int, columns: list[str], time: str, row_id: str):
        self.gap, self.columns, self.time, self.row_id = gap, columns, time, row_id

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        frame = pd.concat([_named(f, self.columns) for f in rows], ignore_index=True)
        frame = frame.sort_values([self.time, self.row_id], ignore_index=True)
        t = frame[self.time].to_numpy(np.int64)
        before = self.last.get()
        last = None if before is None else before[0]
        kept, at = [], 0 if last is None else int(np.searchsorted(t, last + self.gap))
        while at < len(t):
            kept.append(at)
            last = int(t[at])
            at = int(np.searchsorted(t, last + self.gap))
        if kept:
            self.last.update((last,))
            # from this time on any row is kept, so nothing need be known of the key
            self.handle.registerTimer(-(-(last + self.gap) // 1000))
            yield frame.iloc[kept].drop(columns=[self.time])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        before = self.last.get()
        if before is not None and before[0] + self.gap <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def throttle_keyed(df: DataFrame, key: str, at: str, gap_seconds: float, row_id: str, delay: str) -> DataFrame:
    """Throttle a stream with one number of state per key that was heard of within the gap.

    Per key, in time order, a row is skipped if it is younger than the gap since the last
    kept one; of rows of one instant the lowest ``row_id`` stands. Rows more than ``delay``
    behind the newest one are dropped. A key's state goes when the watermark has passed its
    last kept time by the gap, so the state holds active keys only. Null keys are a key;
    rows without a time are dropped.
    """
    gap = round(gap_seconds * 1_000_000)
    if gap <= 0:
        raise ValueError("gap_seconds must be above 0; without a gap every instant is kept")
    use_rocksdb(df.sparkSession)
    timed = df.where(F.col(at).isNotNull()).withColumn("__t", F.unix_micros(F.col(at)))
    grouped = timed.withWatermark(at, delay).groupBy(key)
    return grouped.transformWithStateInPandas(
        statefulProcessor=LastKept(gap, timed.columns, "__t", row_id), outputStructType=df.schema, outputMode="Append", timeMode="EventTime"
    )


class Unseen(StatefulProcessor):
    """Gives the first row of a key, once and never again."""

    def __init__(self, columns: list[str], order: Sequence[str]):
        self.columns, self.order = columns, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.seen.exists():
            for _ in rows:
                pass
            return
        self.seen.update((True,))
        first = None
        for frame in rows:
            frame = _named(frame, self.columns)
            frame = frame if first is None else pd.concat([first, frame], ignore_index=True)
            first = frame.sort_values(self.order, ignore_index=True, na_position="first").head(1)
        yield first

    def close(self) -> None:
        pass


def first_seen_keyed(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key a stream ever shows, in ``order`` within its batch.

    A batch looks up its own keys only, however many were seen before. Rows with a null
    or empty key go.
    """
    use_rocksdb(df.sparkSession)
    present = df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return present.groupBy(key).transformWithStateInPandas(
        statefulProcessor=Unseen(df.columns, order), outputStructType=df.schema, outputMode="Append", timeMode="None"
    )
