"""Near-duplicate documents with Order MinHash.

A text is its sequence of shingles of five words, each labelled with its occurrence. For
each of a number of hash functions the few smallest are sampled and listed in text order;
texts with an equal list meet in a bucket. Candidates are verified by an alignment within a
band of the shingle sequences: with L aligned of m and n, similarity is L / (m + n - L).
Groups are the components of verified links.

Copies collapse to one representative first. In a bucket, all members are compared with
its most central one, so a large group costs one comparison per member and bucket. Members
of buckets that still hold several components (unlike texts around a common line, families
that drift) meet again by a prefix filter. At the threshold two texts have at least
``need`` = 0.8 / 1.8 of their labelled shingles, counted together, in common, so they share
one of the rarest of each, all but the last ``need`` - 1; a common line sorts last.
Under such a shingle members of different components are compared in rounds of growing
numbers of leaders, until it holds one component or each has met all others. So no link
that a bucket holds between components is left out.

Short texts sample fewer shingles, and those near the boundary of lengths sample both ways,
so that a pair above the threshold always shares a way.

Defined cases: a null text is the empty text; empty texts are copies of each other. Texts
under five words are one shingle. Null ids: the row is its own group, with a null group.
Rows repeating an id are one document if equal, and linked if not. An empty table gives an
empty result. Extra columns play no part and pass through :func:`drop_near_copies`.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylarder.llm.graph import components
from skylarder.llm.hot import join_counted
from skylarder.session import release_shuffles, rows_at_a_time, shared_dir

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
#: shingles sampled per band, and of texts with fewer than LONG_FROM shingles
SAMPLED, SAMPLED_SHORT = 8, 3
#: texts from LONG_FROM on sample the long way, texts below SHORT_TO the short way; their ratio is the threshold
SHORT_TO, LONG_FROM = 60, 48
MAX_WORDS = 100_000
#: texts, or pairs of texts, that a Python task gets at a time
TASK_ROWS = 500
#: how many times as many members of a key lead in each round
GROWTH = 16
#: ids that are sent to every task, at most
SENT_IDS = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEEDS = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)
_ODDS = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


class _Known(dict):
    def __missing__(self, word: str) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


class WordHashes:
    """64-bit hashes of words, remembered within bounds."""

    def __init__(self):
        self.known = _Known()

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self.known) > MAX_WORDS:
            self.known = _Known()
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def words_of(text: str) -> list[str]:
    return text.lower().split()


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words; of the whole if it is shorter."""
    n = len(hashes)
    if n == 0:
        return hashes
    if n < SHINGLE:
        return mix((hashes * _FACTORS[:n]).sum(keepdims=True) + np.uint64(n))
    out = np.zeros(n - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        out += hashes[k : n - SHINGLE + 1 + k] * _FACTORS[k]
    return mix(out)


def labelled(grams: np.ndarray) -> np.ndarray:
    """Each shingle with the number of its occurrence, as one hash."""
    order = np.argsort(grams, kind="stable")
    run = grams[order]
    new = np.concatenate([[True], run[1:] != run[:-1]])
    if new.all():
        return grams
    starts = np.flatnonzero(new)
    occurrence = np.empty(len(grams), np.uint64)
    occurrence[order] = np.arange(len(grams)) - np.repeat(starts, np.diff(np.append(starts, len(grams))))
    return np.where(occurrence > 0, mix(grams + occurrence * _FACTORS[0]), grams)


def sketch(grams: np.ndarray) -> np.ndarray:
    """The bucket of each band: a hash of the sampled shingles in text order."""
    n = len(grams)
    if n == 0:
        return np.empty(0, np.int64)
    own = labelled(grams)
    rank = (own[None, :] ^ _SEEDS[:, None]) * _ODDS[:, None]
    rank ^= rank >> np.uint64(32)
    out = []
    for sampled, wanted in ((SAMPLED, n >= LONG_FROM), (SAMPLED_SHORT, n < SHORT_TO)):
        if wanted:
            m = min(sampled, n)
            at = np.argpartition(rank, m - 1, axis=1)[:, :m] if m < n else np.broadcast_to(np.arange(n), (BANDS, n))
            at = np.sort(at, axis=1)
            key = _SEEDS + np.uint64(sampled)
            for k in range(m):
                key = mix(key * _MIX + own[at[:, k]])
            out.append(key)
    return np.concatenate(out).view(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence with places at most ``band`` apart."""
    m = min(len(a), len(b))
    same = a[:m] == b[:m]
    head = m if same.all() else int(np.argmin(same))
    a, b = a[head:], b[head:]
    m = min(len(a), len(b))
    same = a[len(a) - m :][::-1] == b[len(b) - m :][::-1]
    tail = m if same.all() else int(np.argmin(same))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    where: dict[int, list[int]] = {}
    for j, x in enumerate(b.tolist()):
        where.setdefault(x, []).append(j)
    ends: list[int] = []
    for i, x in enumerate(a.tolist()):
        for j in reversed(where.get(x, ())):
            if abs(i - j) <= band:
                at = bisect_left(ends, j)
                if at == len(ends):
                    ends.append(j)
                else:
                    ends[at] = j
    return head + tail + len(ends)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Of two shingle sequences; 0 where the sizes alone, or the shared shingles, keep it below ``least``."""
    m, n = len(a), len(b)
    if m == 0 or n == 0:
        return float(m == n)
    need = least / (1 + least) * (m + n)
    if min(m, n) < need - 1e-9:
        return 0.0
    ua, ub = np.unique(a), np.unique(b)
    if len(ua) == m and len(ub) == n and len(np.intersect1d(ua, ub, assume_unique=True)) < need - 1e-9:
        return 0.0
    # with L of at least `need` aligned, no place can shift by more than what isn't
    found = aligned(a, b, int(m + n - 2 * need) + 1)
    return found / (m + n - found)


def most_similar(a: np.ndarray, b: np.ndarray) -> float:
    """An upper bound of the similarity, from the shingles in common alone."""
    m, n = len(a), len(b)
    if m == 0 or n == 0:
        return float(m == n)
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[i], cb[j]).sum())
    return both / (m + n - both)


# --- over tables --------------------------------------------------------------------


def sketches(docs: DataFrame) -> DataFrame:
    """id, key (128 bits of the text as two longs), buckets."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text").to_pylist()
            for at in range(0, len(texts), 256):
                part = texts[at : at + 256]
                own = [sketch(shingles(hashes(words_of(t)))) for t in part]
                keys = np.array([divmod(xxhash.xxh128_intdigest(t.encode("utf-8", "surrogatepass")), 1 << 64) for t in part], np.uint64).view(np.int64)
                sizes = np.cumsum([0] + [len(x) for x in own]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(part)), pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                     pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(own)))],
                    ["id", "k1", "k2", "buckets"],
                )

    return docs.mapInArrow(run, "id long, k1 long, k2 long, buckets array<long>")


def shingled(texts: DataFrame) -> DataFrame:
    """id, grams: the text's shingles as little-endian 32-bit hashes, all that alignments need."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            ids, texts_ = batch.column("id"), batch.column("text").to_pylist()
            for at in range(0, len(texts_), 256):
                part = [shingles(hashes(words_of(t))).astype("<u4").tobytes() for t in texts_[at : at + 256]]
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(part)), pa.array(part, pa.binary())], ["id", "grams"])

    return texts.select("id", "text").mapInArrow(run, "id long, grams binary")


def only(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of some ids. Up to SENT_IDS ids (8 MB) are sent to the tasks; beyond that both sides are shuffled."""
    few = ids.limit(SENT_IDS + 1).count() <= SENT_IDS
    return texts.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def verify(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """a, b, similarity (0 if certainly below ``least``) for pairs; ``texts`` has id, grams."""

    def run(batches):
        for batch in batches:
            own = [(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")) for x, y in zip(batch["x"], batch["y"])]
            sims = [similarity(x, y, least) if most_similar(x, y) >= least - 1e-9 else 0.0 for x, y in own]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": sims})

    there = pairs.join(texts.select(F.col("id").alias("a"), F.col("grams").alias("x")), "a")
    there = there.join(texts.select(F.col("id").alias("b"), F.col("grams").alias("y")), "b")
    return there.select("a", "b", "x", "y").mapInPandas(run, "a long, b long, similarity double")


def gram_rows(texts: DataFrame) -> DataFrame:
    """id, own (which of the id's texts), size, gram: a row for each labelled shingle."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = part.column("grams").to_pylist()
                own = [labelled(np.frombuffer(x, "<u4").astype(np.uint64)) for x in texts]
                sizes = np.array([len(x) for x in own], np.int32)
                each = [
                    np.array(part.column("id").to_pylist(), np.int64),
                    np.array([xxhash.xxh64_intdigest(x) for x in texts], np.uint64).view(np.int64),
                    sizes,
                ]
                columns = [np.repeat(x, sizes) for x in each] + [np.concatenate(own).view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["id", "own", "size", "gram"])

    return texts.mapInArrow(run, "id long, own long, size int, gram long")


def prefixes(rows: DataFrame, counts: DataFrame, least: float) -> DataFrame:
    """id, size, gram, place: similar texts share one of these, by place in the order of counts.

    Of a text's shingles all but the last ``need`` - 1. Those of one text only come first in
    that order and are in no table: ``counts`` (gram, n) has n > 1.
    """
    text = Window.partitionBy("id", "own")
    ranked = join_counted(rows, counts, "gram", "n").withColumns(
        {"shared": F.count("*").over(text), "at": F.row_number().over(text.orderBy("n", "gram"))}
    )
    need = F.ceil(F.col("size") * F.lit(least) - F.lit(1e-9))
    return ranked.where(F.col("at") <= F.col("shared") + 1 - need).select(
        "id", "size", "gram", (F.col("at") + F.col("size") - F.col("shared")).alias("place")
    )


def links(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(id, rep of its copies) for every document with an id, and (a, b) links between representatives."""
    with rows_at_a_time(docs.sparkSession, TASK_ROWS):
        return _links(docs, least)


def _links(docs: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    base = shared_dir(spark, "order-minhash")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        release_shuffles(spark)
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).where("id IS NOT NULL")
    drawn = stored(sketches(rows), "sketches")
    reps = drawn.groupBy("k1", "k2").agg(F.min("id").alias("rep"))
    copies = stored(drawn.select("id", "k1", "k2").join(reps, ["k1", "k2"]).select("id", "k1", "k2", "rep"), "copies")
    # one row for each text: of repeated rows of one id and text, one
    own = drawn.join(copies.where("id = rep").select("id", "k1", "k2").distinct(), ["id", "k1", "k2"], "left_semi")
    buckets = own.select("id", F.explode("buckets").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(buckets.join(shared, "bucket").distinct(), "members")
    weight = stored(members.groupBy("id").agg(F.sum("n").alias("weight")), "weights")
    texts = stored(shingled(only(rows, weight.select("id"))).distinct(), "texts")

    ranked = members.join(weight, "id")
    centre = ranked.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("id")).alias("at"))).alias("c"))
    pairs = members.join(centre.select("bucket", (-F.col("c.at")).alias("centre")), "bucket").where("id <> centre")
    pairs = pairs.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    checked = stored(pairs, "pairs-0")
    measured = stored(verify(checked, texts, least), "measured-0")
    found = measured.where(F.col("similarity") >= least - 1e-12).select("a", "b").distinct()
    labels = components(found).withColumnRenamed("node", "id")

    def named(rows: DataFrame, key: str) -> DataFrame:
        """Rows with their component, of keys that hold several."""
        rows = rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        mixed = rows.groupBy(key).agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
        return rows.join(mixed.select(key), key, "left_semi")

    left = stored(named(members, "bucket").select("id").distinct(), "left")
    rows = stored(gram_rows(only(texts, left)), "grams")
    counts = stored(rows.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    keys = stored(prefixes(rows, counts, least).distinct(), "prefixes")
    crowds = stored(keys.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "crowds")
    share = F.pmod(F.xxhash64("gram", "id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rest, step = join_counted(keys, crowds, "gram", "n").withColumn("at", share), 0
    while True:
        rest = stored(named(rest.where(F.col("n") > GROWTH**step), "gram"), f"mixed-{step}")
        if rest.isEmpty():
            return copies.select("id", "k1", "k2", "rep"), found
        step += 1
        # each round more lead, and are compared with all that come after them
        lead = rest.where(F.floor(F.col("at") * F.col("n") / GROWTH ** (step - 1)).between(0 if step == 1 else 1, GROWTH - 1))
        lead = lead.select("gram", *(F.col(c).alias(f"{c}_") for c in ("id", "size", "place", "at", "label")))
        # what two texts of these sizes have in common leaves so many places before it in each
        both = F.ceil((F.col("size") + F.col("size_")) * F.lit(least / (1 + least)) - F.lit(1e-9))
        alike = (F.col("place") + both <= F.col("size") + 1) & (F.col("place_") + both <= F.col("size_") + 1)
        new = rest.join(lead, "gram").where("(at, id) > (at_, id_) AND label <> label_").where(alike)
        rest = rest.drop("label")
        new = new.select(F.least("id", "id_").alias("a"), F.greatest("id", "id_").alias("b")).distinct()
        new = stored(new.join(checked, ["a", "b"], "left_anti"), f"pairs-{step}")
        checked = checked.union(new)
        met = stored(verify(new, texts, least).where(F.col("similarity") >= least - 1e-12).select("a", "b"), f"links-{step}")
        if not met.isEmpty():
            found = found.union(met)
            labels = components(found).withColumnRenamed("node", "id")


def groups(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Per document: doc_id, group_id (the smallest id of its group), group_size, kept."""
    copies, found = links(docs, least)
    spark = docs.sparkSession
    # an id whose rows hold different texts is one document
    same = copies.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    odd = same.join(copies.groupBy("id").agg(F.count_distinct("rep").alias("n")).where("n > 1").select(F.col("id").alias("a")), "a", "left_semi")
    label = components(found.union(odd).distinct()).select(F.col("node").alias("rep"), "label")
    of = copies.select("id", "rep").distinct().join(label, "rep", "left").groupBy("id").agg(F.min(F.coalesce("label", "rep")).alias("group_id"))
    at = f"{shared_dir(spark, 'near-groups')}/groups"
    of.write.parquet(at)
    of = spark.read.schema(of.schema).parquet(at)
    sizes = of.groupBy("group_id").agg(F.count("*").alias("group_size"))
    named = of.join(sizes, "group_id").select(F.col("id").alias("doc_id"), "group_id", "group_size", (F.col("id") == F.col("group_id")).alias("kept"))
    none = docs.where("doc_id IS NULL").select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("group_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    return named.union(none)


def drop_near_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of each group, the one of the smallest id, with all columns of ``docs``."""
    gone = groups(docs, least).where("NOT kept").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
