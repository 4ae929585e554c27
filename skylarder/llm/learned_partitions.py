"""Nearest neighbours by learned partitions.

On a bounded sample the neighbour graph is cut into balanced parts; a small classifier
learns, for a vector, in which parts its neighbours lie. Every row is indexed in its most
probable part; a query goes to its most probable parts, as many as reach the wished recall
on the sample, and what is found there is ranked by the exact inner product. Parts are
searched in blocks of bounded size of rows and of queries, so a part that holds a third of
all rows, or one vector repeated, is spread like any other.

Defined cases: vectors that are null, empty, of another length than most of the sample's,
all zero, or hold a null or non-finite component take no part, nor do null ids. Rows
repeating id and vector count once. A query has fewer rows than asked for where there are
fewer candidates. Equal scores go by the smaller id. Empty tables give empty results.
Extra columns play no part.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylarder.session import shared_dir

#: rows that the index is fitted on, at most
SAMPLE_ROWS = 6000
PARTS = 16
GRAPH_NEIGHBOURS = 20
HIDDEN = 64
#: share of true neighbours that routing must reach on the sample
RECALL = 0.96
#: rows, and queries, of a block
BLOCK = 4096
NEAREST = 20


@dataclass
class Index:
    """The classifier (one hidden layer) and the number of parts a query goes to."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts of each vector, most probable first."""
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.argsort(-(np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2), axis=1, kind="stable")


def usable(vector: Column) -> Column:
    """A vector that is there, not zero, and finite throughout."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each row by inner product."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        s = x[at : at + 512] @ x.T
        s[np.arange(len(s)), at + np.arange(len(s))] = -np.inf
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        out[at : at + 512] = np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, 1), axis=1), 1)
    return out


def _halves(edges: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Two equal parts with few edges between: order by the graph's slow mode, then exchange pairs that gain."""
    a, b = edges
    degree = np.maximum(np.bincount(a, minlength=n), 1)
    v = rng.standard_normal(n)
    for _ in range(80):
        v = v - (v * degree).sum() / degree.sum()
        v = 0.5 * v + 0.5 * np.bincount(a, v[b], n) / degree
        v /= np.abs(v).max() or 1.0
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2 :]] = True
    for _ in range(20):
        across = np.bincount(a, side[a] != side[b], n)
        gain = 2 * across - np.bincount(a, minlength=n)
        left, right = (ids[np.argsort(-gain[ids], kind="stable")] for ids in (np.flatnonzero(~side), np.flatnonzero(side)))
        m = min(len(left), len(right))
        swap = np.flatnonzero(gain[left[:m]] + gain[right[:m]] > 2)[: max(1, m // 20)]
        if not len(swap):
            break
        side[left[swap]], side[right[swap]] = True, False
    return side


def balanced_parts(near: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """Halve the graph until there are ``parts`` (a power of two) parts of equal size."""
    rng = np.random.default_rng(seed)
    n, k = near.shape
    a, b = np.repeat(np.arange(n), k), near.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    part = np.zeros(n, np.int64)
    for _ in range(int(np.log2(parts))):
        new = part * 2
        for p in range(part.max() + 1):
            own = np.flatnonzero(part == p)
            if len(own) < 2:
                continue
            place = np.full(n, -1)
            place[own] = np.arange(len(own))
            inside = (place[a] >= 0) & (place[b] >= 0)
            new[own] += _halves(np.stack([place[a[inside]], place[b[inside]]]), len(own), rng)
        part = new
    return part


def _train(x: np.ndarray, target: np.ndarray, seed: int = 11, epochs: int = 40):
    """A softmax classifier with one hidden layer, by Adam in batches, on soft targets."""
    rng = np.random.default_rng(seed)
    d, p = x.shape[1], target.shape[1]
    w = [rng.standard_normal((d, HIDDEN)) * d**-0.5 * 2, np.zeros(HIDDEN), rng.standard_normal((HIDDEN, p)) * HIDDEN**-0.5, np.zeros(p)]
    m, v, t = [np.zeros_like(z) for z in w], [np.zeros_like(z) for z in w], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            own = order[at : at + 256]
            h = np.maximum(x[own] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            e = np.exp(z - z.max(1, keepdims=True))
            back = (e / e.sum(1, keepdims=True) - target[own]) / len(own)
            hidden = (back @ w[2].T) * (h > 0)
            t += 1
            for k, g in enumerate((x[own].T @ hidden, hidden.sum(0), h.T @ back, back.sum(0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - 0.003 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return w


def fit_index(x: np.ndarray, parts: int = PARTS, recall: float = RECALL) -> Index:
    """Fit on a sample, one row a vector."""
    d = x.shape[1]
    while parts > 1 and len(x) < 8 * parts:
        parts //= 2
    if parts == 1:
        return Index(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = neighbour_graph(x, GRAPH_NEIGHBOURS)
    part = balanced_parts(near, parts)
    target = np.zeros((len(x), parts))
    for column in near.T:
        target[np.arange(len(x)), part[column]] += 1
    learn = np.arange(len(x)) % 5 != 0  # the rest measures how well routing carries over
    index = Index(*_train(unit[learn], target[learn] / target[learn].sum(1, keepdims=True)), parts)
    order = index.order(x)
    home = order[:, 0]
    test = np.flatnonzero(~learn)
    rank = np.argsort(order[test], axis=1)  # place of each part in a query's order
    places = np.take_along_axis(rank, home[near[test]], 1)
    reached = [(places < k).mean() for k in range(1, parts + 1)]
    index.probes = next(k for k, r in enumerate(reached, 1) if r >= recall or k == parts)
    return index


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def best_of(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> pd.DataFrame:
    """The k best candidates of each query by (score, smaller id); a query's own row is left out."""
    found = []
    rough = q @ c.T
    rough[q_ids[:, None] == c_ids[None, :]] = -np.inf
    # the fast product may round equal pairs apart: take all near the k-th, then score each alike
    kth = np.partition(rough, -k, axis=1)[:, -k] if len(c_ids) > k else np.full(len(q), -np.inf)
    for i, limit in enumerate(kth):
        row = rough[i]
        at = np.flatnonzero((row >= limit - 1e-9 * (1 + abs(limit))) & (row > -np.inf)) if np.isfinite(limit) else np.flatnonzero(row > -np.inf)
        scores = (c[at] * q[i]).sum(1)
        own = np.lexsort((c_ids[at], -scores))[:k]
        found.append(pd.DataFrame({"query_id": q_ids[i], "vec_id": c_ids[at][own], "score": scores[own]}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def nearest(
    rows: DataFrame, is_query: Column, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding",
    parts: int = PARTS, sample_rows: int = SAMPLE_ROWS, block: int = BLOCK,
) -> DataFrame:
    """For rows under ``is_query`` the k nearest other rows: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    base = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"), is_query.alias("is_query"))
    base = base.where(usable(F.col("v")) & F.col("vec_id").isNotNull()).dropDuplicates(["vec_id", "v"])
    sample = base.select("v", "vec_id").orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample_rows).toPandas()
    if sample.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = Counter(map(len, sample["v"])).most_common(1)[0][0]
    index = fit_index(_matrix(v for v in sample["v"] if len(v) == size), parts)

    def route(batches):
        for batch in batches:
            order = index.order(_matrix(batch["v"])) if len(batch) else np.empty((0, 1), int)
            yield batch.assign(home=order[:, 0], probes=list(order[:, : index.probes]))

    at = f"{shared_dir(spark, 'partitions')}/rows"
    routed = base.where(F.size("v") == size).mapInPandas(route, "vec_id long, v array<double>, is_query boolean, home int, probes array<int>")
    routed.write.parquet(at)
    routed = spark.read.schema(routed.schema).parquet(at)
    probed = routed.where("is_query").select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.explode("probes").alias("part")
    )
    blocks = routed.groupBy(F.col("home").alias("part")).agg(F.ceil(F.count("*") / block).alias("row_blocks"))
    query_blocks = probed.groupBy("part").agg(F.ceil(F.count("*") / block).alias("query_blocks"))
    at = f"{shared_dir(spark, 'partitions')}/shape"
    blocks.join(query_blocks, "part").write.parquet(at)
    shape = lambda: F.broadcast(spark.read.parquet(at))  # noqa: E731  one row per part
    key = ["part", "row_block", "query_block"]
    place = lambda x, n: F.pmod(F.xxhash64(x), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    there = routed.withColumnRenamed("home", "part").join(shape(), "part")
    there = there.select(F.col("part").alias("part"), "vec_id", "v", place("vec_id", "row_blocks").alias("row_block"), every("query_blocks").alias("query_block"))
    asked = probed.join(shape(), "part")
    asked = asked.select("part", "query_id", "q", place("query_id", "query_blocks").alias("query_block"), every("row_blocks").alias("row_block"))

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        cm, ci = _matrix(c["v"]), c["vec_id"].to_numpy()
        return pd.concat(
            best_of(_matrix(part["q"]), part["query_id"].to_numpy(), cm, ci, k)
            for part in (q.iloc[a : a + 512] for a in range(0, len(q), 512))
        )

    found = asked.groupBy(*key).cogroup(there.groupBy(*key)).applyInPandas(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
