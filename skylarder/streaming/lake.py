"""The whole lake as one stream: every layer of a micro-batch, made visible at once.

One query reads both landing folders. A batch writes each dataset under its own folder,
``{root}/batches/{dataset}/run=R/batch=B``, and a marker last. Readers take the batches
that are marked, so a batch that dies between two datasets is invisible; the stream runs
it again under the same number, over the same files, and its folders are replaced.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skylarder.functions.paths import layer_of
from skylarder.operators.dedup import dedup_first
from skylarder.operators.duplicates import duplicate_examples, duplicate_report
from skylarder.operators.throttle import throttle
from skylarder.plans.index import index_docs, observation_id
from skylarder.plans.meals import explode_meals, format_meals, land_meals
from skylarder.plans.merge import recommend
from skylarder.plans.run import Lake
from skylarder.plans.weather import format_weather, normalise_weather, temperature_series
from skylarder.schemas import FORMATTED_MEALS, MEAL_SHARD, RAW_MEALS, WEATHER_RESPONSE
from skylarder.sinks.writers import days_of
from skylarder.sources.readers import or_empty, read_advice, read_geo
from skylarder.streaming.jobs import EVERY_MINUTE, each_batch, stream_files

log = logging.getLogger(__name__)

#: folders of the datasets below the lake's root; the layer says where a mirror puts them
DATASETS = {
    "landed": "raw",
    "raw_meals": "raw",
    "raw_weather": "raw",
    "last_kept": "raw",
    "formatted_meals": "formatted",
    "formatted_weather": "formatted",
    "temperature_timeseries": "usage",
    "enhanced_recommendations": "usage",
    "temperature_index": "usage",
    "enhanced_index": "usage",
}
MARKERS = "marker"
_MARK = "run string, batch bigint"
_LAST = "place string, at timestamp"


@dataclass(frozen=True)
class Batches:
    """The datasets of a lake that arrive in batches."""

    spark: SparkSession
    root: str

    def folder(self, dataset: str) -> str:
        layer = DATASETS.get(dataset)
        return f"{self.root}/batches/{layer}/{dataset}" if layer else f"{self.root}/batches/{dataset}"

    def marked(self) -> DataFrame:
        """run, batch and report of every finished batch."""
        schema = f"{_MARK}, report map<string,string>"
        return or_empty(self.spark, lambda: self.spark.read.schema(schema).parquet(self.folder(MARKERS)), schema, "empty")

    def is_marked(self, run: str, batch: int) -> bool:
        return not self.marked().where((F.col("run") == run) & (F.col("batch") == batch)).isEmpty()

    def read(self, dataset: str, schema: str) -> DataFrame:
        """Rows of all finished batches, with ``run`` and ``batch``."""
        full = f"{schema}, {_MARK}"
        rows = or_empty(self.spark, lambda: self.spark.read.schema(full).parquet(self.folder(dataset)), full, "empty")
        # a marker is a pair of short values; folders of unfinished batches are pruned by the join
        return rows.join(F.broadcast(self.marked().select("run", "batch")), ["run", "batch"], "left_semi")

    def write(self, df: DataFrame, dataset: str, run: str, batch: int, **facts: Column) -> tuple[DataFrame, dict]:
        """Replace the batch's part of a dataset; what is there now, and ``facts`` summed up on the way."""
        path = f"{self.folder(dataset)}/run={run}/batch={batch}"
        seen = Observation(f"{dataset}-{batch}")
        watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in facts.items()])
        watched.write.mode("overwrite").parquet(path, compression="zstd")
        return self.spark.read.schema(df.schema).parquet(path), seen.get

    def mark(self, run: str, batch: int, report: dict[str, object]) -> None:
        told = {k: str(v) for k, v in report.items()}
        row = self.spark.createDataFrame([(told,)], "report map<string,string>")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder(MARKERS)}/run={run}/batch={batch}")


def arriving(spark: SparkSession, lake: Lake, **options) -> DataFrame:
    """Both landing folders as one stream of documents: kind, file, value."""

    def documents(folder: str, kind: str, **how) -> DataFrame:
        files = stream_files(spark, folder, "value string", "text", **how, **options)
        return files.select(F.lit(kind).alias("kind"), F.col("_metadata.file_name").alias("file"), "value")

    # a meal shard is one document per file, a response one line
    return documents(lake.meal_shards, "meals", wholetext="true").unionByName(documents(lake.responses, "weather"))


def parse_landed(documents: DataFrame) -> DataFrame:
    """kind, file, meals, response, and ``broken``: the text of a document that does not parse."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}

    def parsed(kind: str, schema: str):
        return F.when(F.col("kind") == kind, F.from_json("value", f"{schema}, broken string", options))

    given = documents.where(F.trim("value") != "")
    read = given.withColumns({"m": parsed("meals", MEAL_SHARD), "r": parsed("weather", WEATHER_RESPONSE)})
    nothing = F.col("m").isNull() & F.col("r").isNull()
    broken = F.coalesce("m.broken", "r.broken", F.when(nothing, F.col("value")))
    usable = broken.isNull()
    return read.select(
        "kind",
        "file",
        F.when(usable, F.col("m.meals")).alias("meals"),
        F.when(usable & F.col("r").isNotNull(), F.col("r").dropFields("broken")).alias("response"),
        broken.alias("broken"),
    )


def fresh_responses(responses: DataFrame, last: DataFrame, gap_seconds: float | None) -> tuple[DataFrame, DataFrame]:
    """Responses that are old enough after the last kept one of their place, and the last kept times after them."""
    place = F.concat_ws("|", F.col("latitude").cast("string"), F.col("longitude").cast("string"))
    timed = responses.withColumns({"place": place, "at": F.timestamp_seconds("current_time")})
    kept = timed if gap_seconds is None else throttle(timed, "place", "at", gap_seconds, "number", last_kept=last)
    return kept, last.unionByName(kept.select("place", "at")).groupBy("place").agg(F.max("at").alias("at"))


def lake_stream(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str,
    trigger: dict = EVERY_MINUTE,
    seed: str = "",
    gap_seconds: float | None = 120,
    clock: Callable[[], datetime] = datetime.now,
    **options,
) -> StreamingQuery:
    """Meals and responses of a lake, as they land, through all layers to its index.

    A batch parses its documents (broken ones are kept and counted), lands meals that no
    earlier batch had, keeps responses by the freshness rule, formats both, unrolls the
    hourly series, recommends from all meals so far, adds to both indexes what they lack,
    and reports rows and duplicates in its marker. With ``lake.mirror`` the finished batch
    is copied by layer; a failed copy is logged. A new checkpoint is a new run: the index
    takes nothing twice, the other datasets hold each run's batches.
    """
    store = Batches(spark, lake.root)
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def step(batch: DataFrame, number: int) -> None:
        if store.is_marked(run, number):
            return
        at = clock()
        report: dict[str, object] = {"at": at.isoformat()}

        def save(df: DataFrame, dataset: str, **facts: Column) -> DataFrame:
            written, seen = store.write(df, dataset, run, number, **facts)
            report[dataset] = seen.pop("rows")
            report.update({n: v or 0 for n, v in seen.items()})
            return written

        landed = save(parse_landed(batch), "landed", broken=F.count("broken"))

        shards = landed.where("kind = 'meals' AND meals IS NOT NULL").select(F.col("file").alias("shard"), "meals")
        seen = store.read("raw_meals", RAW_MEALS).select(F.explode("meals.idMeal").alias("id")).distinct()
        sizes = {"meals_declared": F.sum("total_meals"), "meals_found": F.sum(F.size("meals"))}
        raw_meals = save(land_meals(shards, at, seen=seen, stored=True), "raw_meals", **sizes)

        responses = landed.where("response IS NOT NULL").select("response.*")
        numbered = responses.withColumn("number", F.monotonically_increasing_id())
        before = (
            spark.read.schema(_LAST).parquet(f"{store.folder('last_kept')}/run={run}/batch={number - 1}")
            if number
            else spark.createDataFrame([], _LAST)
        )
        kept, last = fresh_responses(numbered, before, gap_seconds)
        raw_weather = save(normalise_weather(kept, at), "raw_weather")
        save(last, "last_kept")

        formatted_meals = save(format_meals(explode_meals(raw_meals), at), "formatted_meals")
        weather = save(format_weather(raw_weather, read_geo(spark, lake.geo), at), "formatted_weather")
        series = save(temperature_series(weather), "temperature_timeseries")
        menu = store.read("formatted_meals", FORMATTED_MEALS).drop("run", "batch").unionByName(formatted_meals)
        served = save(
            recommend(weather, menu, read_advice(spark, lake.advice), seed=seed), "enhanced_recommendations"
        )

        for df, dataset, doc_id in ((series, "temperature_index", None), (served, "enhanced_index", observation_id(served))):
            indexed = store.read(dataset, "doc_id string, day string")
            held = indexed.where(days_of(df)(F.col("day")))
            docs = index_docs(df, held, doc_id, stored=True)
            save(docs.withColumn("day", F.substring("@timestamp", 1, 10)), dataset)

        shown = duplicate_report(series, exclude=["@timestamp"]).first()
        report |= {"duplicate_readings": shown.duplicates, "distinct_patterns": shown.distinct_patterns}
        example = duplicate_examples(series, at="@timestamp", order=["@timestamp", "location"], exclude=["@timestamp"]).first()
        if example:
            report["duplicate_example"] = ", ".join(example.first_times)
        store.mark(run, number, report)
        if lake.mirror:
            mirror_batch(store, lake.mirror, run, number)

    return each_batch(arriving(spark, lake, **options), step, checkpoint, trigger)


def mirror_batch(store: Batches, mirror: str, run: str, batch: int) -> list[str]:
    """Copy the datasets of a finished batch to ``{mirror}/{layer}``; returns those that failed."""
    failed = []
    for dataset in DATASETS:
        part = f"{dataset}/run={run}/batch={batch}"
        path = f"{store.folder(dataset)}/run={run}/batch={batch}"
        try:
            layer = store.spark.range(1).select(layer_of(F.lit(path))).first()[0]
            rows = store.spark.read.parquet(path)
            rows.write.mode("overwrite").parquet(f"{mirror.rstrip('/')}/{layer}/{part}")
        except (PySparkException, Py4JJavaError, OSError) as e:  # storage errors surface as JVM errors
            log.warning("mirror of %s failed: %s", path, e)
            failed.append(dataset)
    return failed
