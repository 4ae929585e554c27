"""Token counts by a separator scan over flat token files.

A token file is nothing but 16-bit ids, document after document, each closed by an end id;
no index says where a document stands. Files are scanned in blocks of fixed size, cut
without regard to documents: a block finds its end ids with one vectorised comparison. A
prefix scan over the blocks' summaries (last end id before a block, number of ends before
it) stitches the documents that cross blocks.

Defined cases: two ends in a row are a document of no tokens. Ids after the last end are an
unfinished document, reported with ``closed`` false. A file of an odd number of bytes fails
by name. An empty file has no documents, an empty folder gives an empty result. For
:func:`write_files`: a null text is the empty text, null and repeated ids are written as
they come, an empty table writes no file, extra columns play no part.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylarder.llm.word_bpe import encoder
from skylarder.session import shared_dir

#: ids of a block
BLOCK = 1 << 20
WIDTH = 2
END_ID = 49407


def _open(path: str):
    """(file system, path in it) for any address that Arrow knows; a plain path is local."""
    uri = re.sub(r"^file:/+", "file:///", path)
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), path)


def write_files(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One token file per task under ``folder`` (shared by all executors); file, place, doc_id of what was written.

    A task that runs twice writes two files; only the one in the returned rows counts.
    """

    def write(batches):
        task, own, end = TaskContext.get(), encoder(vocabulary, ordinary=True), np.array([end_id], "<u2")
        name = f"{folder}/tokens-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        at, system, local = 0, *_open(name)
        out = None
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id")
            if out is None and texts:
                system.create_dir(os.path.dirname(local), recursive=True)
                out = system.open_output_stream(local)
            for k in range(0, len(texts), 128):
                part = own.encode(texts[k : k + 128])
                out.write(b"".join(x.astype("<u2").tobytes() + end.tobytes() for x in part))
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(np.arange(at, at + n)), ids.slice(k, n)], ["file", "place", "doc_id"]
                )
                at += n
        if out is not None:
            out.close()

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(write, "file string, place long, doc_id long")


def ends_of(raw: bytes, end_id: int) -> np.ndarray:
    """Places of the end ids in a block."""
    return np.flatnonzero(np.frombuffer(raw, "<u2") == end_id)


def scan(files: DataFrame, end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """Documents of token files (file, length in bytes): file, place, start, n_tokens, closed."""
    spans = files.select("file", "length", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("length") / (WIDTH * block)) - 1))).alias("block"))
    spans = spans.where("length > 0").repartition(F.col("file"), F.col("block"))

    def read(batches):
        for batch in batches:
            rows = []
            for file, length, b in zip(batch["file"], batch["length"], batch["block"]):
                if length % WIDTH:
                    raise ValueError(f"{file}: {length} bytes aren't whole ids")
                system, local = _open(file)
                with system.open_input_file(local) as f:
                    raw = f.read_at(min(WIDTH * block, length - WIDTH * block * b), WIDTH * block * b)
                ends = ends_of(raw, end_id) + b * block
                last = (b + 1) * block * WIDTH >= length
                rows.append((file, b, ends.tolist(), length // WIDTH if last else None))
            yield pd.DataFrame(rows, columns=["file", "block", "ends", "stop"]).astype({"stop": "Int64"})

    found = spans.mapInPandas(read, "file string, block long, ends array<long>, stop long")
    at = f"{shared_dir(files.sparkSession, 'scan')}/blocks"
    found.write.parquet(at)
    found = files.sparkSession.read.schema(found.schema).parquet(at)
    # the prefix scan works on one short row per block
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select("file", "block", F.size("ends").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    carried = carried.select(
        "file", "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).alias("end_before"),
    )
    met = found.join(carried, ["file", "block"])
    closed = met.select("file", "docs_before", "end_before", "ends", F.posexplode("ends").alias("k", "end"))
    start = F.when(F.col("k") == 0, F.col("end_before")).otherwise(F.try_element_at("ends", F.col("k"))) + 1
    closed = closed.select("file", (F.col("docs_before") + F.col("k")).alias("place"), start.alias("start"), (F.col("end") - start).alias("n_tokens"), F.lit(True).alias("closed"))
    tail_start = F.coalesce(F.try_element_at("ends", F.lit(-1)), F.col("end_before")) + 1
    tail = met.where("stop IS NOT NULL").select("file", (F.col("docs_before") + F.size("ends")).alias("place"), tail_start.alias("start"), (F.col("stop") - tail_start).alias("n_tokens"), F.lit(False).alias("closed")).where("n_tokens > 0")
    return closed.union(tail)


def files_under(spark: SparkSession, folder: str) -> DataFrame:
    """file, length of the token files in a folder; contents aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select(F.col("path").alias("file"), "length")


def counts(docs: DataFrame) -> DataFrame:
    """Write documents as token files, scan the files, and say whose each count is: doc_id, n_tokens, file_no, place, start."""
    spark = docs.sparkSession
    base = shared_dir(spark, "token-files")
    order = write_files(docs, f"{base}/tokens")
    order.write.parquet(f"{base}/order")
    order = spark.read.schema(order.schema).parquet(f"{base}/order").withColumn("name", F.substring_index("file", "/", -1))
    written = order.select("name").distinct()
    if written.isEmpty():
        return spark.createDataFrame([], "doc_id long, n_tokens long, file_no int, place long, start long")
    there = files_under(spark, f"{base}/tokens").withColumn("name", F.substring_index("file", "/", -1))
    found = scan(there.join(written, "name", "left_semi")).withColumn("name", F.substring_index("file", "/", -1))
    number = F.regexp_extract("name", r"tokens-(\d+)-", 1).cast("int")
    return order.select("name", "place", "doc_id").join(found.drop("file"), ["name", "place"]).select("doc_id", "n_tokens", number.alias("file_no"), "place", "start")
