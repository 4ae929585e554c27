"""Lines that many documents hold stay in one of them.

Every text is exploded into lines. A line's key is the line without ASCII white space at
its ends, A-Z in lower case; keys of at least ``LEAST_CHARS`` code points are kept as 128
bits with the document's id and the line's place. Distinct documents are counted per key,
and lines whose key is in ``LEAST_DOCS`` or more go, except in the document of the largest
id that holds it. Only places travel back: a document's text is cut by them and the other
lines are joined by position. Counting merges a key's rows before each shuffle, and keys
that hold a large share of all lines are met by a bounded broadcast (:mod:`hot`), so a line
in a third of all documents loads no single task.

Defined cases: a null or empty text is one empty line. Rows repeating an id are one
document where documents are counted, and each row is cut by its own lines. A row without
an id counts for no key and keeps none, so it loses the lines that enough others hold. A
document whose lines all go has the empty text. An empty table gives an empty result. Extra
columns pass through :func:`drop_common_lines` and play no part.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylarder.llm.hot import join_counted
from skylarder.session import shared_dir

LEAST_CHARS = 20
LEAST_DOCS = 3
_BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    inner = F.btrim(line, F.lit(_BLANKS))
    plain = F.octet_length(inner) == F.length(inner)
    # lower() knows more letters than A-Z, but not among ASCII
    return F.when(plain, F.lower(inner)).otherwise(
        F.translate(inner, string.ascii_uppercase, string.ascii_lowercase)
    )


def _own(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    """Id, text and what tells rows of one id apart."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return F.col(f"`{id_col}`"), text, F.xxhash64(text)


def keyed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """id, row, place, key of every line whose key is long enough."""
    own_id, text, row = _own(docs, id_col, text_col)
    lines = docs.select(own_id.alias("id"), row.alias("row"), F.posexplode(F.split(text, "\n")).alias("place", "line"))
    keys = lines.select("id", "row", "place", line_key(F.col("line")).alias("key"))
    return keys.where(F.length("key") >= least_chars).withColumn("key", F.unhex(F.md5("key")))


def common_keys(lines: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """key, n_docs, n_lines, largest (id) of the keys that enough documents hold."""
    return (
        lines.groupBy("key")
        .agg(F.count_distinct("id").alias("n_docs"), F.count("*").alias("n_lines"), F.max("id").alias("largest"))
        .where(F.col("n_docs") >= least_docs)
    )


def dropped_places(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """id, row, places of the lines that go, for each text that loses any."""
    spark, base = docs.sparkSession, shared_dir(docs.sparkSession, "lines")
    lines = keyed_lines(docs, id_col, text_col, least_chars)
    lines.write.parquet(f"{base}/lines")
    lines = spark.read.schema(lines.schema).parquet(f"{base}/lines")
    common = common_keys(lines, least_docs)
    common.write.parquet(f"{base}/common")
    common = spark.read.schema(common.schema).parquet(f"{base}/common")
    met = join_counted(lines, common, "key", "n_lines").where(~F.col("id").eqNullSafe(F.col("largest")))
    return met.groupBy("id", "row").agg(F.collect_set("place").alias("places"))


def _cut(docs: DataFrame, id_col: str, text_col: str, least_chars: int, least_docs: int) -> DataFrame:
    """``docs`` with __text, __lines and __places, the places null where nothing goes."""
    gone = dropped_places(docs, id_col, text_col, least_chars, least_docs)
    gone = gone.select(F.col("id").alias("__id"), F.col("row").alias("__row"), F.col("places").alias("__places"))
    own_id, text, row = _own(docs, id_col, text_col)
    rows = docs.select("*", own_id.alias("__own"), text.alias("__text"), row.alias("__own_row"))
    met = F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__own_row") == F.col("__row"))
    return rows.join(gone, met, "left").withColumn("__lines", F.split("__text", "\n"))


def _kept() -> Column:
    places = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__places"))
    rest = F.array_join(F.transform(places, lambda k: F.get(F.col("__lines"), k)), "\n")
    return F.when(F.col("__places").isNull(), F.col("__text")).otherwise(rest)


def drop_common_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """``docs`` with all its columns, the texts without the lines that go; untouched texts stay as they are."""
    cut = _cut(docs, id_col, text_col, least_chars, least_docs)
    text = F.when(F.col("__places").isNull(), F.col(f"`{text_col}`")).otherwise(_kept())
    return cut.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """Per row of ``docs``: its id, n_lines, n_dropped, kept_sha256."""
    cut = _cut(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), id_col, text_col, least_chars, least_docs)
    return cut.select(
        F.col(f"`{id_col}`"),
        F.size("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__places"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(_kept().cast("binary"), 256).alias("kept_sha256"),
    )
