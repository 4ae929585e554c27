"""Queries over the given tables, each exercising one operator or job on a whole table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylarder import functions as fn
from skylarder import operators as op
from skylarder import plans, streaming
from skylarder.plans.index import observation_id
from skylarder.schemas import RECOMMENDATIONS
from skylarder.session import shared_dir
from skylarder.sinks.writers import write_index
from skylarder.workload import inputs
from skylarder.workload.inputs import table

AS_OF = datetime(2024, 12, 19, 15, 30, 45)
SEED = "menu"
THROTTLE_SECONDS = 86_400

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- scalar functions -------------------------------------------------------


@query
def prep_time(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", fn.prep_time(F.col("p_name")).alias("minutes")
    )


@query
def prep_time_documents(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", fn.prep_time(F.col("text")).alias("minutes")
    )


@query
def clean_steps(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", fn.clean_steps(F.col("text")).alias("steps")
    )


@query
def wide_pairs(spark, sf):
    names = [
        F.col("p_brand"),
        F.nullif(F.col("p_name"), F.lit("blue bolt")),
        F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type")),
    ]
    amounts = [
        F.nullif(F.col("p_type"), F.lit("SMALL")),
        F.col("p_size").cast("string"),
        F.lit(""),
    ]
    return table(spark, sf, "part").select("p_partkey", fn.wide_pairs(names, amounts).alias("pairs"))


@query
def temp_category(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", fn.temperature_category(inputs.event_temperature()).alias("category")
    )


@query
def fallback_advice(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", fn.fallback_advice(inputs.event_temperature()).alias("advice")
    )


@query
def normalise_measures(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.round_half_even(F.col("l_extendedprice") * F.col("l_discount"), 1).alias("measure"),
        fn.round_half_even(F.col("l_extendedprice") / 1000, 4).alias("coordinate"),
        fn.round_to_int(F.col("l_quantity") / 2).alias("elevation"),
    )


@query
def format_size(spark, sf):
    n = F.col("n_chars")
    return table(spark, sf, "documents").select(
        "doc_id",
        fn.format_size(n).alias("size"),
        fn.format_size(n * n * 64).alias("large_size"),
        fn.format_size(n * n * n * 256).alias("huge_size"),
    )


@query
def layer_route(spark, sf):
    path = F.col("url")
    for lang, layer in (("en", "raw"), ("fr", "formatted"), ("de", "usage")):
        path = F.replace(path, F.lit(f"/{lang}/"), F.lit(f"/{layer}/"))
    return table(spark, sf, "pages").select("page_id", fn.layer_of(path).alias("layer"))


@query
def snapshot_names(spark, sf):
    name = fn.snapshot_name("raw", "weather", F.col("ts").cast("timestamp"), "json")
    return (
        table(spark, sf, "events")
        .select("event_id", name.alias("name"))
        .withColumn("parsed", fn.time_text(fn.snapshot_time(F.concat(F.lit("/lake/raw/"), F.col("name")))))
    )


@query
def time_texts(spark, sf):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select(
        "event_id",
        fn.epoch_to_iso(seconds).alias("iso"),
        fn.epoch_to_date(seconds).alias("day"),
        fn.compact_time(fn.epoch_to_iso(seconds)).alias("plain"),
    )


@query
def repair_timezone(spark, sf):
    landed = F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_mktsegment")).otherwise(
        F.concat(F.lit("b'"), F.col("c_mktsegment"), F.lit("'"))
    )
    return table(spark, sf, "customer").select("c_custkey", fn.repair_timezone(landed).alias("timezone"))


@query
def json_records(spark, sf):
    fields = table(spark, sf, "events").select(
        "event_id", "event_type", F.nullif(F.col("event_type"), F.lit("view")).alias("kind"), "value"
    )
    return fields.select("event_id", fn.json_record(["event_type", "kind", "value"]).alias("record"))


@query
def json_parse(spark, sf):
    """Typed rows from JSON text; text that does not parse is kept apart."""
    parsed = F.from_json(
        F.when(F.col("event_type") == "error", F.substring("props", 1, 5)).otherwise(F.col("props")),
        "k int, broken string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"},
    )
    return (
        table(spark, sf, "events")
        .select("event_id", parsed.alias("doc"))
        .select("event_id", "doc.k", F.col("doc.broken").isNotNull().cast("int").alias("is_broken"))
    )


# --- nulls and quality ------------------------------------------------------


@query
def empty_to_null(spark, sf):
    voided = table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "fr", "").otherwise(F.col("lang")).alias("lang"),
        F.when(F.col("source") == "src1", " ").otherwise(F.col("source")).alias("source"),
    )
    return op.empty_to_null(voided, "lang", "source")


@query
def null_gate(spark, sf):
    """Observations with a temperature, dropping exact zeros as well."""
    t = inputs.event_temperature()
    return (
        table(spark, sf, "events")
        .select("event_id", t.alias("temperature"))
        .filter("temperature is not null and temperature != 0")
    )


@query
def dq_nulls(spark, sf):
    events = table(spark, sf, "events").select(
        "ts", inputs.event_temperature().alias("temperature"), F.nullif("event_type", F.lit("view")).alias("kind")
    )
    return op.null_counts(events, ["ts", "temperature", "kind"])


# --- series, nesting --------------------------------------------------------


@query
def time_grid_zip(spark, sf):
    """Hour grids of one or three days against vectors of 64 values."""
    start = F.lit(1_704_067_200) + F.col("vec_id") * 86_400
    days = F.when(F.col("label") < 5, 1).otherwise(3)
    grid = op.time_grid(start, start + days * 86_400, F.lit(3600))
    pairs = op.zip_short(grid, F.col("embedding"), ("at", "value"))
    return (
        table(spark, sf, "embeddings")
        .select("vec_id", F.inline(pairs))
        .select("vec_id", "at", F.col("value").cast("double").alias("value"))
    )


@query
def renest(spark, sf):
    nested = op.renest(
        table(spark, sf, "conversations"),
        items=["role", "text"],
        order=[F.col("turn")],
        keys=["conv_id"],
        name="turns",
        max_items=3,
    )
    return nested.select(
        "conv_id",
        "part",
        "total",
        "n",
        F.array_join(F.transform("turns", lambda t: F.concat_ws(": ", t["role"], t["text"])), "\n").alias("transcript"),
    )


@query
def explode_series(spark, sf):
    nested = op.renest(
        table(spark, sf, "conversations"),
        items=["turn", "role", "text"],
        order=[F.col("turn")],
        keys=["conv_id"],
    )
    return op.unnest(nested, "items", keep=["conv_id"])


@query
def envelope_check(spark, sf):
    nested = op.renest(
        table(spark, sf, "conversations"),
        items=["turn"],
        order=[F.col("turn")],
        keys=["conv_id"],
        max_items=3,
    )
    return op.count_check(nested, "items", "n")


@query
def number_rows(spark, sf):
    """Position of each order among those of its customer."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    placed = op.position_within(
        orders,
        order=[F.col("o_orderdate"), F.col("o_orderkey")],
        keys=["o_custkey"],
        total="orders",
    )
    return placed.select("o_orderkey", "pos", "orders")


# --- joins ------------------------------------------------------------------


@query
def nearest_advice(spark, sf):
    events = table(spark, sf, "events").select("event_id", inputs.event_temperature().alias("temperature"))
    return op.nearest_join(
        events,
        inputs.advice(spark, sf).withColumnRenamed("temperature", "at"),
        on="temperature",
        key="at",
        pos="pos",
        value="advice",
        name="advice",
        fallback=fn.fallback_advice,
    )


@query
def nearest_price(spark, sf):
    """Against a lookup that grows with the data: the part with the nearest price."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price")
    )
    return op.nearest_join(
        items,
        table(spark, sf, "part"),
        on="unit_price",
        key="p_retailprice",
        pos="p_partkey",
        value="p_name",
        name="part_name",
    )


@query
def random_pick(spark, sf):
    picked = op.random_pick(
        table(spark, sf, "orders").select("o_orderkey"),
        table(spark, sf, "part").select("p_partkey", "p_name"),
        key="o_orderkey",
        choice_key="p_partkey",
        seed=SEED,
    )
    return picked.select("o_orderkey", "pick.p_partkey", "pick.p_name")


def _geo(spark, sf) -> DataFrame:
    """Positions of nations; one region is not covered."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.filter("n_regionkey != 4").select(
        (F.col("n_nationkey") * 2.0).alias("lat"),
        (F.col("n_nationkey") * 3.0).alias("lon"),
        F.when(F.col("n_regionkey") == 0, "").otherwise(F.nullif("n_name", F.lit("NATION_1"))).alias("city"),
        F.when(F.col("n_regionkey") == 0, F.col("n_name")).alias("town"),
        F.when(F.col("n_regionkey") == 2, F.lit(None)).otherwise(F.col("r_name")).alias("country"),
    )


@query
def place_name(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey",
        (F.col("c_nationkey") * 2.0 + 0.001).alias("lat_here"),
        (F.col("c_nationkey") * 3.0).alias("lon_here"),
    )
    return op.enrich_place(customers, _geo(spark, sf), "lat_here", "lon_here").select("c_custkey", "place")


@query
def nearest_place(spark, sf):
    """The nearest place on the globe, however far, and the metres to it."""
    return op.nearest_place(
        inputs.positions(spark, sf), inputs.crowded_places(spark, sf), "lat_here", "lon_here", F.col("city"), metres="metres"
    ).select("c_custkey", "place", "metres")


@query
def as_of_menu(spark, sf):
    """Readings at invented times, each with its customer's latest order by then."""
    at = F.expr("TIMESTAMP_NTZ '1995-01-01 00:00:00' + make_dt_interval(cast(event_id * 7 % 2500 AS int))")
    readings = table(spark, sf, "events").select("event_id", "user_id", at.alias("read_at"))
    met = op.asof_join(
        readings, table(spark, sf, "orders"), "read_at", "o_orderdate", [("user_id", "o_custkey")], ["o_orderkey"], "last"
    )
    return met.select("event_id", "last.o_orderkey", "last.o_orderdate")


# --- aggregation, dedup -----------------------------------------------------


@query
def dedup_first(spark, sf):
    return op.dedup_first(table(spark, sf, "events"), "user_id", ["ts", "event_id"])


@query
def union_dedup(spark, sf):
    """Two sources one after the other, the first text of each id kept."""
    first = table(spark, sf, "benchmark").select(F.lit("a").alias("shard"), F.col("item_id").alias("id"), "text")
    second = table(spark, sf, "documents").select(F.lit("b").alias("shard"), F.col("doc_id").alias("id"), "text")
    return op.dedup_first(first.unionByName(second), "id", ["shard", "text"])


@query
def duplicate_report(spark, sf):
    return op.duplicate_report(table(spark, sf, "events").select("event_type", "value", "ts"), exclude=["ts"])


@query
def duplicate_examples(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "event_type", "user_id", fn.time_text(F.col("ts").cast("timestamp")).alias("at")
    )
    found = op.duplicate_examples(events, at="at", order=["event_id"], exclude=["event_id"])
    return found.select("times", F.array_join("first_times", ", ").alias("first_times"))


@query
def latest_snapshot(spark, sf):
    return op.latest_snapshot(table(spark, sf, "orders"), "o_orderdate", ["o_custkey"])


@query
def latest_snapshot_all(spark, sf):
    return op.latest_snapshot(table(spark, sf, "orders"), "o_orderdate")


@query
def storage_inventory(spark, sf):
    return op.inventory_of(table(spark, sf, "documents"), "source", "n_chars")


@query
def inventory_diff(spark, sf):
    """What is lost per language when only labelled documents stay."""
    documents = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("layer"), "n_chars")
    labelled = documents.join(table(spark, sf, "labels"), "doc_id", "left_semi")

    def listing(df):
        return op.inventory_of(df, "layer", "n_chars").withColumn("dirs", F.lit(0))

    return op.inventory_diff(listing(documents), listing(labelled)).drop("dirs_removed")


@query
def throttle(spark, sf):
    return op.throttle(table(spark, sf, "events"), "user_id", "ts", THROTTLE_SECONDS, "event_id")


# --- jobs -------------------------------------------------------------------


@query
def format_meals(spark, sf):
    formatted = plans.format_meals(inputs.raw_meals(spark, sf), AS_OF)
    return formatted.withColumn("processed_date", F.col("processed_date").cast("string"))


@query
def land_meals(spark, sf):
    """Raw meals nested by category into shards, with copies, then merged again."""
    raw = inputs.raw_meals(spark, sf)
    copies = raw.withColumn("shard", F.lit("b")).unionByName(raw.withColumn("shard", F.lit("a")))
    shards = op.renest(
        copies,
        items=raw.columns,
        order=[F.col("idMeal")],
        keys=["shard"],
        name="meals",
        max_items=64,
    )
    shards = shards.select(F.concat_ws("-", "shard", F.lpad("part", 9, "0")).alias("shard"), "meals")
    landed = plans.land_meals(shards, AS_OF)
    meals = landed.select("fetch_timestamp", "total_meals", F.explode("meals").alias("meal"))
    return meals.select("meal.idMeal", "meal.strCategory", "meal.strInstructions", "fetch_timestamp")


@query
def normalise_weather(spark, sf):
    """Responses whose vectors are embeddings, as hourly rows of normalised weather."""
    e = F.col("embedding")
    start = F.lit(1_704_067_200) + F.col("vec_id") * 86_400
    responses = table(spark, sf, "embeddings").select(
        "vec_id",
        (e[0].cast("double") * 90).alias("latitude"),
        (e[1].cast("double") * 180).alias("longitude"),
        (e[2].cast("double") * 1000).alias("elevation"),
        F.lit("UTC").alias("timezone"),
        start.alias("current_time"),
        F.slice(e, 4, 3).alias("current_values"),
        start.alias("hourly_start"),
        (start + 86_400).alias("hourly_end"),
        F.lit(3600).cast("bigint").alias("hourly_interval"),
        e.alias("hourly_values"),
        start.alias("daily_start"),
        (start + 86_400).alias("daily_end"),
        F.lit(86_400).cast("bigint").alias("daily_interval"),
        F.slice(e, 7, 1).alias("daily_values"),
    )
    raw = plans.normalise_weather(responses, AS_OF, keep=["vec_id"])
    return raw.select(
        "vec_id",
        "metadata.latitude",
        "metadata.longitude",
        "metadata.elevation",
        F.col("current.time").alias("current_time"),
        F.col("current.wind_speed_10m").alias("wind_speed"),
        F.col("daily")[0]["date"].alias("day"),
        F.col("daily")[0]["uv_index_max"].alias("uv"),
        F.explode("hourly").alias("hour"),
    ).select("*", "hour.time", "hour.temperature_2m").drop("hour")


@query
def format_weather(spark, sf):
    customers = table(spark, sf, "customer")
    raw = customers.select(
        "c_custkey",
        F.struct(
            (F.col("c_nationkey") * 2.0).alias("latitude"),
            (F.col("c_nationkey") * 3.0 - 0.001).alias("longitude"),
            F.lit(7).cast("bigint").alias("elevation"),
            F.concat(F.lit("b'"), F.col("c_mktsegment"), F.lit("'")).alias("timezone"),
            F.lit("t").alias("fetch_timestamp"),
        ).alias("metadata"),
        F.struct(
            F.lit("t").alias("time"),
            F.col("c_acctbal").alias("temperature_2m"),
            F.lit(0.0).alias("relative_humidity_2m"),
            F.lit(0.0).alias("wind_speed_10m"),
        ).alias("current"),
        F.array().cast("array<struct<time:string,temperature_2m:double>>").alias("hourly"),
        F.array().cast("array<struct<date:string,uv_index_max:double>>").alias("daily"),
    )
    formatted = plans.format_weather(raw, _geo(spark, sf), AS_OF, keep=["c_custkey"])
    return formatted.select(
        "c_custkey",
        "location.name",
        "location.latitude",
        "location.timezone",
        F.col("current.temperature_2m").alias("temperature"),
        "formatted_timestamp",
    )


@query
def timeseries(spark, sf):
    """Readings nested into documents per user, then unrolled to an hourly series."""
    events = table(spark, sf, "events").select(
        "user_id",
        "event_id",
        fn.epoch_to_iso(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("time"),
        inputs.event_temperature().alias("temperature_2m"),
    )
    hours = op.renest(
        events,
        items=["time", "temperature_2m"],
        order=[F.col("time"), F.col("event_id")],
        keys=["user_id"],
        name="hourly",
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    weather = hours.join(customers, F.col("user_id") == F.col("c_custkey"), "left").select(
        F.struct(
            F.nullif(F.col("c_name"), F.lit("Customer#000000007")).alias("name"),
            (F.col("c_nationkey") * 2.5).alias("latitude"),
            (F.col("c_custkey") / 4.0).alias("longitude"),
            F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("timezone"),
        ).alias("location"),
        "hourly",
    )
    return plans.temperature_series(weather)


@query
def recommend(spark, sf):
    weather = inputs.observations(table(spark, sf, "events"), table(spark, sf, "customer"))
    return plans.recommend(
        weather, inputs.menu(spark, sf), inputs.advice(spark, sf), key="event_id", seed=SEED
    )


@query
def recommend_history(spark, sf):
    """Every observation of a history from the menu that was valid at its time."""
    weather = inputs.observations(table(spark, sf, "events"), table(spark, sf, "customer"))
    return plans.recommend_history(
        weather, inputs.menus(spark, sf), inputs.advice(spark, sf), key="event_id", seed=SEED
    )


@query
def index_recommendations(spark, sf):
    """The index after the first half of the month, the whole, and the whole again."""
    path = f"{shared_dir(spark, 'index')}/enhanced"
    events, customers = table(spark, sf, "events"), table(spark, sf, "customer")
    for some in (events.where("ts < '2024-01-16'"), events, events):
        served = plans.recommend(inputs.observations(some, customers), inputs.menu(spark, sf), inputs.advice(spark, sf))
        write_index(served, path, observation_id(served))
    return spark.read.parquet(path).select("@timestamp", "location", "latitude", "longitude", F.col("day").cast("string"))


@query
def index_docs(spark, sf):
    """Every event arrives twice; those of one type are already in the index."""
    events = table(spark, sf, "events").select(
        "event_id", "event_type", fn.time_text(F.col("ts").cast("timestamp")).alias("at")
    )
    doc_id = F.md5(F.concat_ws("|", F.col("event_id").cast("string"), "event_type", "at"))
    existing = plans.index_docs(events.filter("event_type = 'purchase'"), doc_id=doc_id)
    return plans.index_docs(events.unionAll(events), existing, doc_id=doc_id)


# --- streams: the table's files arrive, everything present is processed --------


def _event_stream(spark, sf) -> DataFrame:
    schema = table(spark, sf, "events").schema
    stream = streaming.stream_files(spark, sf, schema, "parquet", pattern="events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_dedup(spark, sf):
    """Users seen, each once."""
    base = shared_dir(spark, "stream-dedup")
    users = streaming.dedup_within(_event_stream(spark, sf).select("user_id", "ts"), "user_id", "ts", "60 days")
    streaming.to_files(users.select("user_id"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema("user_id bigint").parquet(f"{base}/out")


@query
def stream_first_seen(spark, sf):
    base = shared_dir(spark, "stream-first-seen")
    streaming.first_seen(
        _event_stream(spark, sf), "user_id", ["ts", "event_id"], f"{base}/out", f"{base}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("user_id", "event_id", "event_type")


@query
def stream_throttle(spark, sf):
    base = shared_dir(spark, "stream-throttle")
    streaming.throttle_stream(
        _event_stream(spark, sf),
        "user_id",
        "ts",
        THROTTLE_SECONDS,
        "event_id",
        f"{base}/out",
        f"{base}/state",
        f"{base}/checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id")


@query
def stream_recommend(spark, sf):
    base = shared_dir(spark, "stream-recommend")
    weather = inputs.observations(_event_stream(spark, sf), table(spark, sf, "customer"))
    streaming.recommend_stream(
        weather,
        inputs.menu(spark, sf),
        inputs.advice(spark, sf),
        f"{base}/out",
        f"{base}/checkpoint",
        key="event_id",
        seed=SEED,
    ).awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("batch")


@query
def stream_throttle_keyed(spark, sf):
    """The throttle with state per key, in the state store."""
    base = shared_dir(spark, "stream-throttle-keyed")
    kept = streaming.throttle_keyed(_event_stream(spark, sf), "user_id", "ts", THROTTLE_SECONDS, "event_id", "1 day")
    streaming.to_files(kept.select("event_id", "user_id"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema("event_id bigint, user_id bigint").parquet(f"{base}/out")


@query
def stream_first_seen_keyed(spark, sf):
    base = shared_dir(spark, "stream-first-seen-keyed")
    first = streaming.first_seen_keyed(_event_stream(spark, sf), "user_id", ["ts", "event_id"])
    first = first.select("user_id", "event_id", "event_type")
    streaming.to_files(first, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(first.schema).parquet(f"{base}/out")


@query
def stream_lake(spark, sf):
    """Meals and responses landed as files, through all layers of the lake, to its recommendations."""
    lake = plans.Lake(shared_dir(spark, "lake"))
    inputs.land_lake(spark, sf, lake)
    streaming.lake_stream(
        spark, lake, f"{lake.root}/checkpoint", streaming.AVAILABLE, SEED, THROTTLE_SECONDS
    ).awaitTermination()
    store = streaming.Batches(spark, lake.root)
    return store.read("enhanced_recommendations", RECOMMENDATIONS).drop("run", "batch")
