"""Exact dedup with built-in functions only.

Texts are grouped by a 128-bit content hash. The grouping key of the first, map-side
aggregation holds the text itself beside its hash, so bytes are compared inside every
hash group; a hash under which more than one text was found (a collision) is resolved
by a second pass over just those rows. Copies collapse before the shuffle, so a text
held by a third of all rows costs one row per task; the join back to the rows is thin
(an id and a hash) and adaptive execution splits it where one hash is hot.

Defined cases: a null text is the empty text. A row with a null id belongs to its group
and counts, but stays only where no row of the group has an id. Rows repeating both id
and text are listed and counted each, with the same verdict; :func:`drop_copies` keeps one
of them. An empty table gives an empty result. Extra columns, whatever
their names, pass through :func:`drop_copies` unchanged and play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylarder.session import shared_dir


#: hashes or decisions that are sent to every task, at most
SENT_HASHES = 1 << 19


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def _texts(docs: DataFrame, id_col: str, text_col: str, hash_fn) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("__id"), text.alias("__text")).withColumn(
        "__hash", hash_fn(F.col("__text"))
    )


def _chosen(keep: str) -> Column:
    return F.max("__id") if keep == "largest" else F.min("__id")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", hash_fn=content_hash
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    ``keep`` says which id of equal texts stays. ``hash_fn`` maps the text to its hash;
    the result doesn't depend on it.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    spark = docs.sparkSession
    rows = _texts(docs, id_col, text_col, hash_fn)
    thin = rows.select("__id", "__hash", "__text")
    groups = (
        thin.groupBy("__hash", "__text")
        .agg(_chosen(keep).alias("keep_id"), F.count("*").alias("group_size"))
        .withColumn("text_sha256", F.sha2("__text", 256))
        .drop("__text")
    )
    at = f"{shared_dir(spark, 'exact-groups')}/groups"
    groups.write.parquet(at)
    groups = spark.read.schema(groups.schema).parquet(at)
    collided = groups.groupBy("__hash").count().where("count > 1").select("__hash")
    ids = rows.select("__id", "__hash")
    if collided.isEmpty():
        found = ids.join(groups, "__hash")
    else:
        clean = ids.join(groups.join(collided, "__hash", "left_anti"), "__hash")
        members = rows.join(collided, "__hash", "left_semi").withColumn("text_sha256", F.sha2("__text", 256))
        by_text = members.groupBy("__hash", "__text").agg(
            _chosen(keep).alias("keep_id"), F.count("*").alias("group_size")
        )
        found = clean.unionByName(
            members.join(by_text, ["__hash", "__text"]).select(*clean.columns)
        )
    return found.select(
        F.col("__id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", hash_fn=content_hash
) -> DataFrame:
    """The rows whose document stays, with all columns of ``docs``; of repeated rows one stays.

    Hashes alone are counted first. Rows of a hash that no other row has stay where they
    are; texts are compared, and move, only where a hash is met again. The decisions are
    thin, and up to SENT_HASHES of them are sent to the tasks.
    """
    at = shared_dir(docs.sparkSession, "exact-copies")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{at}/{name}")
        return docs.sparkSession.read.schema(df.schema).parquet(f"{at}/{name}")

    def thin(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.limit(SENT_HASHES + 1).count() <= SENT_HASHES else df

    ids, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.withColumn("__keep", ids).withColumn("__hash", hash_fn(text))
    again = thin(stored(rows.groupBy("__hash").agg(F.count("*").alias("n")).where("n > 1").select("__hash"), "again"))
    alone = rows.join(again, "__hash", "left_anti").select(*(rows[f"`{c}`"] for c in docs.columns))
    met = rows.join(again, "__hash", "left_semi")
    keep_row = met.groupBy("__hash", text.alias("__text")).agg(F.min("__keep") if keep == "smallest" else F.max("__keep"))
    kept = keep_row.toDF("__hash", "__text", "__keep").select("__keep", F.sha2("__text", 256).alias("__sha"))
    kept = stored(kept, "kept").withColumnsRenamed({"__keep": "__id", "__sha": "__of"})
    met = met.withColumn("__sha", F.sha2(text, 256))
    found = met.join(thin(kept), met["__keep"].eqNullSafe(kept["__id"]) & (met["__sha"] == kept["__of"]), "left_semi")
    once = found.dropDuplicates(["__keep", "__sha"])
    return alone.union(once.select(*(once[f"`{c}`"] for c in docs.columns)))
