"""What each of five quality filters removes, in every order, from sorted posting lists.

Documents are marked once with the filters they fail. Marks are sorted by part and id and
cut into ranges of at most ``RANGE`` documents; a range keeps, per filter, the sorted list
of its failing documents, and the lists of good and of toxic ones. What a filter removes
after others is the difference of its list and the union of theirs: unions are merged list
by list, each shorter list galloping through the longer one, once per set of filters. Sizes
add up over ranges, so a part of any size is worked on range by range, and 80 sizes a part
(five filters after each of the 16 sets of the others) give all 120 orders.

A document is an entry of its range, by position; entries keep rows repeating an id apart.

Defined cases: a null text is empty, a null part is the empty string. Rows repeating an id
are documents of their own and share the labels of that id; of several labels of an id any
that says 1 counts, null says nothing. Filter E fails a row whose text a row of a smaller
id holds; a row without an id neither fails E nor lets others fail, and has no labels. An
empty table gives an empty result. Extra columns play no part.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylarder.llm.hot import join_counted
from skylarder.session import shared_dir

FILTERS = "ABCDE"
#: documents whose lists are merged at once
RANGE = 8192
_BLANK = r"[\x20\x09-\x0D]+"

LISTS = f"part string, first_id long, last_id long, n_docs long, ids array<long>, {', '.join(f'fails_{f} array<int>' for f in FILTERS)}, good array<int>, toxic array<int>"
SIZES = "part string, letter int, earlier int, n_docs long, fails long, removed long, gone long, good long, toxic long"


def fails_alone(text: Column) -> dict[str, Column]:
    """The filters that need no other document."""
    words = F.array_remove(F.split(text, _BLANK), "")
    n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n < 200,
        "B": 100 * distinct < 50 * n,
        "C": 100 * capitals.cast("long") > 3 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def marks(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """part, id, good, toxic and one boolean per filter, for every row of ``docs``."""
    spark, base = docs.sparkSession, shared_dir(docs.sparkSession, "marks")
    rows = docs.select(
        F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    alone = rows.select(
        "part", "id", *[c.alias(f) for f, c in fails_alone(F.col("text")).items()], F.unhex(F.sha2("text", 256)).alias("copy")
    )
    alone.write.parquet(f"{base}/alone")
    alone = spark.read.schema(alone.schema).parquet(f"{base}/alone")
    firsts = alone.groupBy("copy").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts.write.parquet(f"{base}/firsts")
    firsts = spark.read.schema(firsts.schema).parquet(f"{base}/firsts")
    full = join_counted(alone, firsts, "copy", "n", "left").withColumn("E", F.coalesce(F.col("id") > F.col("first"), F.lit(False)))
    said = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    named = full.where("id IS NOT NULL").join(said, "id", "left")
    unnamed = full.where("id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    yes = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")]
    return named.unionByName(unnamed).select("part", "id", *FILTERS, *yes)


def posting_lists(marked: DataFrame, size: int = RANGE) -> DataFrame:
    """Per part and range of ids: the ids, and which entries fail each filter, are good, are toxic."""
    spark, base = marked.sparkSession, shared_dir(marked.sparkSession, "postings")
    marked.write.parquet(f"{base}/marked")
    marked = spark.read.schema(marked.schema).parquet(f"{base}/marked")
    columns = [*FILTERS, "good", "toxic"]

    def list_ranges(batches):
        for batch in batches:
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            ids = batch.column("id")
            held = [np.asarray(batch.column(c).to_numpy(zero_copy_only=False), bool) for c in columns]
            cuts = np.flatnonzero(parts[1:] != parts[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(parts)]
            spans = [(a, min(a + size, end)) for at, end in zip(bounds, bounds[1:]) for a in range(at, end, size)]
            known = [[i for i in (ids[a].as_py(), ids[b - 1].as_py())] for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([parts[a] for a, _ in spans], pa.string()),
                    pa.array([k[0] for k in known], pa.int64()),
                    pa.array([k[1] for k in known], pa.int64()),
                    pa.array([b - a for a, b in spans], pa.int64()),
                    pa.array([ids.slice(a, b - a).to_pylist() for a, b in spans], pa.list_(pa.int64())),
                    *[pa.array([np.flatnonzero(h[a:b]).astype(np.int32) for a, b in spans], pa.list_(pa.int32())) for h in held],
                ],
                names=["part", "first_id", "last_id", "n_docs", "ids", *[f"fails_{f}" for f in FILTERS], "good", "toxic"],
            )

    ranged = marked.repartitionByRange("part", "id").sortWithinPartitions("part", "id")
    lists = ranged.mapInArrow(list_ranges, LISTS)
    lists.write.parquet(f"{base}/lists")
    return spark.read.schema(LISTS).parquet(f"{base}/lists")


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Entries of the sorted list ``a`` that the sorted list ``b`` lacks; the shorter gallops through the longer."""
    if not len(a) or not len(b):
        return a
    if len(a) <= len(b):
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        return a[b[at] != a]
    at = np.searchsorted(a, b)
    found = at[at < len(a)]
    found = found[a[found] == b[: len(at)][at < len(a)]]
    return np.delete(a, found)


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two sorted lists as one, without repeats."""
    if len(a) < len(b):
        a, b = b, a
    new = minus(b, a)
    return np.insert(a, np.searchsorted(a, new), new)


def list_sizes(fails: list[np.ndarray], good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """For each filter after each set of others: fails, removed, gone, good and toxic ones among the removed.

    Row ``letter * 32 + earlier``, where ``earlier`` has a bit per filter; other rows are zero.
    """
    sizes = np.zeros((len(FILTERS) * 32, 5), np.int64)
    gone = {0: np.empty(0, np.int32)}
    for some in range(1, 32):
        last = some.bit_length() - 1
        gone[some] = union(gone[some ^ (1 << last)], fails[last])
    for k, own in enumerate(fails):
        for earlier in range(32):
            if earlier >> k & 1:
                continue
            removed = minus(own, gone[earlier])
            held = [len(removed) - len(minus(removed, labelled)) for labelled in (good, toxic)]
            sizes[k * 32 + earlier] = len(own), len(removed), len(gone[earlier | 1 << k]), *held
    return sizes


def summed_sizes(lists: DataFrame) -> DataFrame:
    """Sizes per part, filter and set of earlier filters, over all ranges."""
    pruned = lists.drop("ids", "first_id", "last_id")

    def merge(batches):
        empty = np.empty(0, np.int32)
        for batch in batches:
            found: dict[str, np.ndarray] = {}
            columns = [batch.column(c) for c in (*[f"fails_{f}" for f in FILTERS], "good", "toxic")]
            for r in range(batch.num_rows):
                part, n = batch.column("part")[r].as_py(), batch.column("n_docs")[r].as_py()
                *fails, good, toxic = [np.asarray(c[r].values) if len(c[r].values) else empty for c in columns]
                sizes = np.insert(list_sizes(fails, good, toxic), 0, n, axis=1)
                found[part] = found.get(part, 0) + sizes
            used = [k * 32 + s for k in range(len(FILTERS)) for s in range(32) if not s >> k & 1]
            for part, sizes in found.items():
                own = sizes[used]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(used), pa.string()),
                        pa.array([u // 32 for u in used], pa.int32()),
                        pa.array([u % 32 for u in used], pa.int32()),
                        *[pa.array(own[:, c]) for c in range(6)],
                    ],
                    names=["part", "letter", "earlier", "n_docs", "fails", "removed", "gone", "good", "toxic"],
                )

    sums = [F.sum(c).alias(c) for c in ("n_docs", "fails", "removed", "gone", "good", "toxic")]
    return pruned.mapInArrow(merge, SIZES).groupBy("part", "letter", "earlier").agg(*sums)


def orders(spark) -> DataFrame:
    """filter_order, step, letter, earlier: five rows for each of the 120 orders."""
    rows = [
        ("".join(order), k + 1, FILTERS.index(f), sum(1 << FILTERS.index(e) for e in order[:k]))
        for order in permutations(FILTERS)
        for k, f in enumerate(order)
    ]
    return spark.createDataFrame(rows, "filter_order string, step int, letter int, earlier int")


def interactions(lists: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: what is kept, removed, redundant, lost, and the filter's Shapley sum."""
    spark, at = lists.sparkSession, f"{shared_dir(lists.sparkSession, 'sizes')}/sizes"
    sizes = summed_sizes(lists)
    sizes.write.parquet(at)
    sizes = spark.read.schema(sizes.schema).parquet(at)
    others = F.bit_count("earlier")
    ways = F.create_map(*[F.lit(x) for n in range(5) for x in (n, factorial(n) * factorial(4 - n))])[others]
    shares = sizes.groupBy("part", "letter").agg(
        F.sum(F.col("removed") * ways).cast("long").alias("shapley"),
        F.sum(F.when(others == len(FILTERS) - 1, F.col("removed"))).alias("unique_fails"),
    )
    steps = sizes.join(F.broadcast(orders(spark)), ["letter", "earlier"]).join(shares, ["part", "letter"])
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("n_docs") - F.col("gone")).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails",
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        "shapley",
    )


def audit(docs: DataFrame, labels: DataFrame, size: int = RANGE) -> DataFrame:
    """All steps of all orders of the five filters over ``docs``, per language."""
    return interactions(posting_lists(marks(docs, labels), size))
