"""The training-data pipeline over documents: what is fit to train on, packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylarder.llm import best_fit, compact_windows, exact_dedup, order_minhash, toxicity
from skylarder.llm.tables import table
from skylarder.session import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't predict toxic; it learns from the labels of its training fold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("toxicity") < 0.5).drop("toxicity")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of the smallest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of near copies the document of the smallest id."""
    return order_minhash.drop_near_copies(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; a text that held nothing else goes."""
    return compact_windows.drop_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands among the training sequences."""
    return best_fit.pack(best_fit.cut(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("substring dedup", drop_repeated_passages),
    ("best-fit packing", pack_sequences),
]

#: models and alignments have no SQL; tests hold the stages against brute force
ORACLE_SQL = None


#: rows that a Python task gets at a time, with their whole texts; each stands there several times over
TASK_ROWS = 1000
_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in turn; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    base = shared_dir(spark, "pipeline")
    before = spark.conf.get(_ROWS_CONF)
    spark.conf.set(_ROWS_CONF, min(TASK_ROWS, int(before)) if int(before) > 0 else TASK_ROWS)
    try:
        for k, (_, stage) in enumerate(STAGES):
            done = stage(spark, docs, sf_dir)
            done.write.parquet(f"{base}/{k}")
            docs = spark.read.schema(done.schema).parquet(f"{base}/{k}")
    finally:
        spark.conf.set(_ROWS_CONF, before)
    return docs
