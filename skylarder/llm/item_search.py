"""Ranked lexical search, reversed: the documents stream through an index of the items.

The terms of the items are few and the documents many, so the inverted index is that of
the items: for each term the items that hold it. It is broadcast, and each task streams its
documents' term counts through it. A first pass counts documents, terms and, for the terms
of the index, the documents that hold them; the second scores. A task keeps a heap of the
``TOP`` best documents per item and emits only those; heaps are merged in two rounds.

Items are worked on in blocks of at most ``BLOCK_BYTES`` of text, measured before anything
is broadcast, one pass over the documents each. Scores are sums of whole numbers below
2^53, so the doubles that collect them are exact; items with more terms than that allows
are summed in slices.

Defined cases: a null text has no terms, and a document or item without terms finds
nothing. Rows repeating a doc_id are documents of their own; a row without a doc_id counts
and is ranked after others of its score. Rows repeating an item_id are ranked each by
itself. Empty tables give an empty result. Extra columns play no part.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylarder.session import shared_dir

TOP = 10
#: item text per broadcast index
BLOCK_BYTES = 8 << 20
#: scores held at once by a task
CELLS = 1 << 20
#: bytes of a text that are split into terms at once
SLICE = 1 << 20
#: terms that hold 1000 * ln(2^63) * 10^6 each and still sum to less than 2^53
EXACT_TERMS = 200_000

_TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b | 0x20 if chr(b).isupper() else 0x20
    for b in range(256)
)

COUNTS = "term int, n long, total long"
HEAPS = "item int, id long, score long"


def terms_of(text: str):
    """Terms of a text in lists, a bounded stretch of it at a time."""
    raw = text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + SLICE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def term_counts(text: str | None) -> Counter:
    counts: Counter = Counter()
    for terms in terms_of(text or ""):
        counts.update(terms)
    return counts


class ItemIndex:
    """For each term of some items the items that hold it, as slices of one array."""

    def __init__(self, texts: list[str | None]):
        self.n_items = len(texts)
        held = [sorted(term_counts(t)) for t in texts]
        self.vocabulary = {t: k for k, t in enumerate(sorted({t for own in held for t in own}))}
        terms = np.array([self.vocabulary[t] for own in held for t in own], np.int64)
        items = np.repeat(np.arange(len(texts)), [len(own) for own in held])
        order = np.argsort(terms, kind="stable")
        self.items = items[order]
        self.sizes = np.bincount(terms, minlength=len(self.vocabulary)).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.weights = np.zeros(len(self.vocabulary), np.int64)

    def weigh(self, n_docs: int, total: int, holding: dict[int, int]) -> None:
        """Weights of the terms, given how many documents there are, their terms, and who holds each."""
        df = np.array([holding.get(k, 0) for k in range(len(self.vocabulary))], np.float64)
        self.weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        self.n_docs, self.total = n_docs, total

    def found(self, counts: Counter) -> list[tuple[int, int]]:
        """(term, occurrences) of a document's terms that the index holds."""
        known = self.vocabulary
        return [(known[t], counts[t]) for t in known.keys() & counts.keys()]

    def scores(self, counts: list[Counter]) -> np.ndarray:
        """Score of each document for each item."""
        out = np.zeros(len(counts) * self.n_items, np.int64)
        found = [self.found(c) for c in counts]
        lengths = [c.total() for c in counts]
        sizes = [len(f) for f in found]
        doc = np.repeat(np.arange(len(counts)), sizes)
        term = np.array([t for f in found for t, _ in f], np.int64)
        tf = np.array([n for f in found for _, n in f], np.int64)
        slope = np.array([10 + 90 * n * self.n_docs // self.total for n in lengths], np.int64)
        gain = self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * slope[doc]))
        # a document meets an item at most once per term, so slices of its terms keep sums exact
        rank = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        for low in range(0, max(sizes, default=0), EXACT_TERMS):
            own = np.flatnonzero((rank >= low) & (rank < low + EXACT_TERMS))
            per = self.sizes[term[own]]
            ends = np.cumsum(per)
            place = np.repeat(self.starts[term[own]] - ends + per, per) + np.arange(ends[-1] if len(ends) else 0)
            cell = np.repeat(doc[own] * self.n_items, per) + self.items[place]
            out += np.bincount(cell, np.repeat(gain[own], per), len(out)).astype(np.int64)
        return out.reshape(len(counts), self.n_items)


class Heaps:
    """The best documents of each item so far."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.item = np.empty(0, np.int64)
        self.id = np.empty(0, np.int64)
        self.nameless = np.empty(0, bool)
        self.score = np.empty(0, np.int64)
        self.least = np.ones(n_items, np.int64)

    def add(self, ids: np.ndarray, nameless: np.ndarray, scores: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        if not len(doc):
            return
        item = np.concatenate([self.item, item])
        own_id = np.concatenate([self.id, ids[doc]])
        no_name = np.concatenate([self.nameless, nameless[doc]])
        score = np.concatenate([self.score, scores[doc, item[len(self.item) :]]])
        order = np.lexsort((own_id, no_name, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        best = order[rank < self.top]
        self.item, self.id, self.nameless, self.score = item[rank < self.top], own_id[best], no_name[best], score[best]
        full = rank == self.top - 1
        self.least[item[full]] = score[order[full]]


def _texts(batch: pa.RecordBatch, column: str = "text"):
    return (v.as_py() for v in batch.column(column))


def count_terms(docs: DataFrame, index) -> DataFrame:
    """term, n: documents holding each term of the index; term -1: documents with terms, and all their terms."""

    def count(batches):
        known = index.value.vocabulary
        df, n_docs, total = np.zeros(len(known), np.int64), 0, 0
        for batch in batches:
            for text in _texts(batch):
                held: set[bytes] = set()
                length = 0
                for terms in terms_of(text or ""):
                    length += len(terms)
                    held.update(terms)
                total += length
                n_docs += length > 0
                df[[known[t] for t in known.keys() & held]] += 1
        terms = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(terms, -1), pa.int32()),
                pa.array(np.append(df[terms], n_docs), pa.int64()),
                pa.array(np.append(terms * 0, total), pa.int64()),
            ],
            names=["term", "n", "total"],
        )

    sums = docs.mapInArrow(count, COUNTS).groupBy("term")
    return sums.agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def best_of_tasks(docs: DataFrame, index, top: int = TOP) -> DataFrame:
    """item, id, score: each task's best documents of each item of the index."""

    def search(batches):
        own = index.value
        heaps = Heaps(own.n_items, top)
        at_once = max(1, CELLS // own.n_items)
        for batch in batches:
            ids = batch.column("id")
            nameless = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), bool)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for low in range(0, batch.num_rows, at_once):
                part = batch.slice(low, at_once)
                scores = own.scores([term_counts(t) for t in _texts(part)])
                heaps.add(ids[low : low + at_once], nameless[low : low + at_once], scores)
        yield pa.RecordBatch.from_arrays(
            [pa.array(heaps.item, pa.int32()), pa.array(heaps.id, pa.int64(), mask=heaps.nameless), pa.array(heaps.score, pa.int64())],
            names=["item", "id", "score"],
        )

    return docs.mapInArrow(search, HEAPS)


def merged(heaps: DataFrame, top: int = TOP) -> DataFrame:
    """item, rank, id, score: the best over all tasks, first within salted shares of them."""
    best_first = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    share = Window.partitionBy("item", "share").orderBy(*best_first)
    some = heaps.withColumn("share", F.pmod(F.xxhash64("id", "score"), F.lit(32)))
    some = some.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    every = Window.partitionBy("item").orderBy(*best_first)
    return some.withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= top).drop("share")


def _blocks(numbered: DataFrame, most_bytes: int) -> list[list]:
    """Rows of the items, dealt into as many blocks as keep each below the bound; each is read when its turn comes."""
    text_bytes = F.octet_length(F.coalesce("text", F.lit(""))) + 64
    n_items, total = numbered.agg(F.count("*"), F.sum(text_bytes)).first()
    blocks = max(1, -(-(total or 0) // most_bytes))
    while True:
        dealt = numbered.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
        largest = dealt.groupBy("block").agg(F.sum(text_bytes).alias("b")).agg(F.max("b")).first()[0] or 0
        if largest <= most_bytes or blocks >= n_items:
            break
        blocks = min(2 * blocks, n_items)
    for k in range(blocks):
        rows = dealt.where(F.col("block") == k).select("item", "text").collect()
        if rows:
            yield rows


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item."""
    spark, base = docs.sparkSession, shared_dir(docs.sparkSession, "search")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    numbered = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text"))
    numbered.withColumn("item", F.monotonically_increasing_id()).write.parquet(f"{base}/items")
    numbered = spark.read.parquet(f"{base}/items")
    found = None
    for k, block in enumerate(_blocks(numbered, block_bytes)):
        index = ItemIndex([r.text for r in block])
        plain = spark.sparkContext.broadcast(index)
        sums = {r.term: r for r in count_terms(rows.select("text"), plain).collect()}
        if not sums or not sums[-1].n:
            break
        index.weigh(sums[-1].n, sums[-1].total, {t: r.n for t, r in sums.items() if t >= 0})
        weighed = spark.sparkContext.broadcast(index)
        best = merged(best_of_tasks(rows, weighed, top), top)
        names = spark.createDataFrame([(i, r.item) for i, r in enumerate(block)], "at int, item long")
        best = best.join(F.broadcast(names), best["item"] == names["at"]).select(names["item"], "rank", "id", "score")
        best.write.parquet(f"{base}/best/block={k}")
        found = best.schema
    if found is None:
        found = "item long, rank int, id long, score long"
        best = spark.createDataFrame([], found)
    else:
        best = spark.read.schema(found).parquet(f"{base}/best/block=*")
    return best.join(numbered.select("item", "item_id"), "item").select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score"
    )
