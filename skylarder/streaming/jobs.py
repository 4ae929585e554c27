"""Streams of arriving files. Batches of one query never overlap."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skylarder.operators.dedup import dedup_first
from skylarder.operators.throttle import throttle
from skylarder.plans.merge import recommend
from skylarder.sources.readers import or_empty

# Triggers: the cadence of the lake, or everything that has arrived and then stop.
EVERY_MINUTE = {"processingTime": "1 minute"}
AVAILABLE = {"availableNow": True}


def stream_files(
    spark: SparkSession, folder: str, schema, fmt: str = "json", pattern: str | None = None, **options
) -> DataFrame:
    """Files of a folder as they arrive. ``maxBytesPerTrigger`` bounds a batch."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def to_files(
    df: DataFrame, out: str, checkpoint: str, trigger: dict = AVAILABLE, fmt: str = "parquet"
) -> StreamingQuery:
    """Append a stream to files, each row exactly once across restarts."""
    writer = df.writeStream.format(fmt).option("path", out).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger).start()


def each_batch(
    df: DataFrame,
    step: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict = AVAILABLE,
) -> StreamingQuery:
    """Run ``step`` per batch. It may run again for the same batch id after a failure."""
    writer = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def dedup_within(df: DataFrame, key: str, at: str, delay: str) -> DataFrame:
    """First-seen rows of a stream, remembering keys for ``delay`` of event time.

    Repeats within an Arrow batch go before the shuffle, so a hot key reaches its
    stateful task as one row per batch.
    """

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.table({"k": batch.column(key), "i": np.arange(batch.num_rows)})
            first = rows.group_by("k").aggregate([("i", "min")]).column("i_min").to_numpy()
            yield batch.take(pa.array(np.sort(first)))

    present = df.filter(F.col(key).isNotNull())
    thinned = present.mapInArrow(thin, present.schema)
    return thinned.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def first_seen(
    df: DataFrame,
    key: str,
    order: Sequence[Column | str],
    out: str,
    checkpoint: str,
    trigger: dict = AVAILABLE,
) -> StreamingQuery:
    """Append rows whose key is in no earlier batch, one per key, without forgetting.

    The output is the memory: a batch is met with the keys written before it, and
    writes its own folder, so running it again changes nothing.
    """
    spark = df.sparkSession

    def step(batch: DataFrame, batch_id: int) -> None:
        kind = batch.schema[key].dataType.simpleString()
        memory = f"`{key}` {kind}, batch bigint"
        seen = or_empty(spark, lambda: spark.read.schema(memory).parquet(out), memory, "empty")
        fresh = dedup_first(batch, key, order).join(
            seen.filter(F.col("batch") < batch_id).select(key), key, "left_anti"
        )
        fresh.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return each_batch(df, step, checkpoint, trigger)


def throttle_stream(
    df: DataFrame,
    key: str,
    at: str,
    gap_seconds: float,
    row_id: str,
    out: str,
    state: str,
    checkpoint: str,
    trigger: dict = AVAILABLE,
) -> StreamingQuery:
    """Throttle a stream, carrying the last kept time of each key between batches.

    Within a batch rows are taken in time order; a row that arrives in a later
    batch than a newer kept row of its key is skipped. The state of a batch is a
    dataset of its own, derived from that of the batch before.
    """
    spark = df.sparkSession

    def step(batch: DataFrame, batch_id: int) -> None:
        memory = batch.select(key, at).schema
        # only the first batch may be without a state
        before = or_empty(
            spark,
            lambda: spark.read.schema(memory).parquet(f"{state}/batch={batch_id - 1}"),
            memory,
            "error" if batch_id else "empty",
        )
        kept = throttle(batch, key, at, gap_seconds, row_id, last_kept=before)
        kept.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        # read back what was written instead of computing it again
        added = spark.read.schema(memory).parquet(f"{out}/batch={batch_id}")
        last = before.union(added).groupBy(key).agg(F.max(at).alias(at))
        last.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    return each_batch(df, step, checkpoint, trigger)


def recommend_stream(
    weather: DataFrame,
    meals: DataFrame,
    advice: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict = AVAILABLE,
    key: str | None = None,
    seed: str = "",
) -> StreamingQuery:
    """Recommend for each arriving batch of weather, with the lookups as listed when the stream starts."""

    def step(batch: DataFrame, batch_id: int) -> None:
        served = recommend(batch, meals, advice, key=key, seed=seed)
        served.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return each_batch(weather, step, checkpoint, trigger)
