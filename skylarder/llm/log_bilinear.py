"""Scores texts with a log-bilinear neural language model trained by noise-contrastive estimation.

Output and context symbols are classes: the end, the commonest words, each its own class,
and for all other words classes of shape (letters used, length, closing mark). The model
gives the class after the two before it; within a class a word has its smoothed share of
the class's count. Class trigrams are counted over every training text; the parameters are
trained with numpy on shards of those counts, each of which is met in every round with
exactly its count, noise drawn from the class frequencies, and averaged over the shards. Because contexts are pairs of classes, one batch of
matrix products normalises the model for all of them, and a text is scored by lookups.

Word counts cover all training texts. The commonest words' counts go to the tasks; the
rarer words of each text meet their counts in a join, summed back by text.

Defined cases: a null or empty text is the end alone. Null ids are training rows unless
their fold says otherwise (they have none, so they train). Repeated rows are scored and
counted each. A corpus without training rows has zero counts, and the model is uniform.
Empty tables give empty results. Extra columns play no part.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylarder.session import shared_dir

FOLDS, HELD_OUT = 5, 1
#: words whose counts every task gets
SENT_WORDS = 1 << 17
#: words a worker process remembers beyond those
MAX_WORDS = 300_000
CLASSES = 192
SHAPES = 72
DIMENSION = 32
NOISE = 32
SHARDS = 8
ROUNDS = 2
#: a round of a shard has about STEPS batches, and more if it holds many rare trigrams
STEPS = 700
BATCH = 1024
END = 0

_GERMAN, _FRENCH, _SPANISH = map(frozenset, ("äöüßÄÖÜ", "éèêëàâçîïôûùœÉÈÊÀÇ", "ñíóáúÑÍÓÁÚ"))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shape(word: bytes) -> int:
    """0 to 71: by letters, closing mark and length."""
    last = word[-1]
    mark = 1 if last == 44 else 2 if last == 46 else 3 if last < 128 and not word[-1:].isalnum() else 0
    core = word[:-1] if mark else word
    if core.isalpha():
        letters = 0
    elif core.isascii():
        letters = 4
    else:
        used = set(core.decode("utf-8", "replace"))
        letters = 1 if used & _GERMAN else 2 if used & _FRENCH else 3 if used & _SPANISH else 5
    return (letters * 4 + mark) * 3 + (len(core) > 4) + (len(core) > 8)


class Words:
    """Numbers words within a task: first those given, then others as they come, with their class."""

    def __init__(self, given: list[bytes]):
        self.given, self.singles = given, CLASSES - SHAPES - 1
        self._start()

    def _start(self) -> None:
        self.place = {w: k for k, w in enumerate(self.given)}
        self.names = list(self.given)
        own = [k + 1 if k < self.singles else self.singles + 1 + shape(w) for k, w in enumerate(self.given)]
        self.classes = np.array(own, np.int32)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.place) > len(self.given) + MAX_WORDS:
            self._start()
        new = [w for w in set(words) if w not in self.place]
        if new:
            self.place.update(zip(new, range(len(self.names), len(self.names) + len(new))))
            self.names += new
            self.classes = np.concatenate([self.classes, np.array([self.singles + 1 + shape(w) for w in new], np.int32)])
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of each token, -1 for ends; class of each token; number of tokens of each text)."""
        split = [words_of(t) for t in texts]
        sizes = np.array([len(s) + 1 for s in split], np.int64)
        numbers = self.numbers([w for s in split for w in s])
        ends = np.cumsum(sizes) - 1
        ids = np.full(int(sizes.sum()), -1, np.int64)
        inside = np.ones(len(ids), bool)
        inside[ends] = False
        ids[inside] = numbers
        classes = np.zeros(len(ids), np.int32)
        classes[inside] = self.classes[numbers]
        return ids, classes, sizes


def contexts(classes: np.ndarray) -> np.ndarray:
    """The pair of classes before each token as one number; before a text's start stands the end."""
    one = np.concatenate([[END], classes[:-1]])
    two = np.concatenate([[END], one[:-1]])
    two = np.where(one == END, END, two)
    return two * CLASSES + one


def _batches(batch: pa.RecordBatch, size: int = 128):
    texts = batch.column("text").to_pylist()
    for at in range(0, len(texts), size):
        yield at, [t or "" for t in texts[at : at + size]]


# --- what is counted over the training texts -------------------------------------


def word_counts(train: DataFrame) -> DataFrame:
    """word (binary), n over all texts; the end isn't among them."""

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for _, texts in _batches(batch):
                seen.update(w for t in texts for w in words_of(t))
                if len(seen) > MAX_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "n"])
                    seen = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "n"])

    return train.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def trigram_counts(train: DataFrame, given: list[bytes]) -> DataFrame:
    """cell (context and class as one number), n over all texts."""

    def count(batches):
        own = Words(given)
        held: list[np.ndarray] = []
        room = 0

        def out():
            cells, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(n, pa.int64())], ["cell", "n"])

        for batch in batches:
            for _, texts in _batches(batch):
                _, classes, _ = own.texts(texts)
                held.append((contexts(classes) * CLASSES + classes).astype(np.int32))
                room += len(classes)
                if room > 4_000_000:
                    yield out()
                    held, room = [], 0
        if held:
            yield out()

    return train.select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))


# --- the model --------------------------------------------------------------------


@dataclass
class Parameters:
    """Context vectors by place, target vectors and biases."""

    before: np.ndarray  # [2, CLASSES, DIMENSION]
    target: np.ndarray  # [CLASSES, DIMENSION]
    bias: np.ndarray  # [CLASSES]

    def flat(self) -> np.ndarray:
        return np.concatenate([self.before.ravel(), self.target.ravel(), self.bias])

    @staticmethod
    def of(flat: np.ndarray) -> "Parameters":
        n = CLASSES * DIMENSION
        return Parameters(flat[: 2 * n].reshape(2, CLASSES, DIMENSION), flat[2 * n : 3 * n].reshape(CLASSES, DIMENSION), flat[3 * n :])

    @staticmethod
    def start(share: np.ndarray, seed: int = 5) -> "Parameters":
        rng = np.random.default_rng(seed)
        return Parameters(rng.normal(0, 0.1, (2, CLASSES, DIMENSION)), rng.normal(0, 0.1, (CLASSES, DIMENSION)), np.log(share))

    def log10_table(self) -> np.ndarray:
        """Normalised log10 probabilities [context, class], in batches of matrix products."""
        out = np.empty((CLASSES * CLASSES, CLASSES), np.float32)
        for two in range(CLASSES):
            z = (self.before[0][two] + self.before[1]) @ self.target.T + self.bias
            z -= z.max(1, keepdims=True)
            z -= np.log(np.exp(z).sum(1, keepdims=True))
            out[two * CLASSES : (two + 1) * CLASSES] = z / np.log(10)
        return out


def _gathered(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of rows by class."""
    places = at[:, None] * DIMENSION + np.arange(DIMENSION)
    return np.bincount(places.ravel(), rows.ravel(), CLASSES * DIMENSION).reshape(CLASSES, DIMENSION)


def visits(n: np.ndarray, batches: int) -> tuple[np.ndarray, np.ndarray]:
    """(which cell, weight) so that about ``batches`` batches meet every cell with exactly its count.

    A cell is met once for each whole share of a batch's place, and once for what is left,
    so weights are at most 1; there are at most ``batches`` * BATCH visits and one a cell.
    """
    share = n * (batches * BATCH / n.sum(dtype=float))
    whole = np.floor(share).astype(np.int64)
    left = share - whole
    rest = np.flatnonzero(left > 0)
    return np.concatenate([np.repeat(np.arange(len(n)), whole), rest]), np.concatenate([np.ones(int(whole.sum())), left[rest]])


def train_shard(start: Parameters, cells: np.ndarray, n: np.ndarray, share: np.ndarray, rate: float, steps: int, seed: int) -> Parameters:
    """Noise-contrastive estimation on all counted tokens in random order: each cell weighs its count against NOISE draws per batch, each standing for its token's share."""
    rng = np.random.default_rng(seed)
    w = [x.astype(np.float32) for x in (start.before[0], start.before[1], start.target, start.bias)]
    g2 = [np.full(x.shape, 1e-8, np.float32) for x in w]
    which, weights = visits(n, steps)
    order = rng.permutation(len(which))
    which, weights = which[order], weights[order].astype(np.float32)
    steps = -(-len(which) // BATCH)
    noise_mass = np.cumsum(share)
    log_noise = np.log(NOISE * share).astype(np.float32)
    for step in range(steps):
        part = slice(step * BATCH, (step + 1) * BATCH)
        cell, weight = cells[which[part]], weights[part]
        two, one, own = cell // (CLASSES * CLASSES), cell // CLASSES % CLASSES, cell % CLASSES
        noise = np.minimum(np.searchsorted(noise_mass, rng.random(NOISE) * noise_mass[-1]), CLASSES - 1)
        h = w[0][two] + w[1][one]
        true = (h * w[2][own]).sum(1) + w[3][own] - log_noise[own]
        false = h @ w[2][noise].T + w[3][noise] - log_noise[noise]
        up = weight / (1 + np.exp(np.clip(true, -30, 30)))  # pull for the data
        down = -weight[:, None] / (1 + np.exp(np.clip(-false, -30, 30)))  # push for the noise
        back = up[:, None] * w[2][own] + down @ w[2][noise]
        grads = [_gathered(two, back), _gathered(one, back), _gathered(own, up[:, None] * h)]
        np.add.at(grads[2], noise, down.T @ h)
        grads.append(np.bincount(own, up, CLASSES) + np.bincount(noise, down.sum(0), CLASSES))
        scale = rate * (1 - 0.9 * step / steps)
        for x, g, v in zip(w, grads, g2):
            g = (g / BATCH).astype(np.float32)
            v *= 0.99
            v += 0.01 * g * g
            x += np.float32(scale) * g / (np.sqrt(v) + np.float32(1e-6))
    return Parameters(np.stack(w[:2]), w[2], w[3])


def train(cells: DataFrame, share: np.ndarray) -> Parameters:
    """Average over shards of the counts, in rounds; a shard's parameters are all that comes back."""
    spark = cells.sparkSession
    at = f"{shared_dir(spark, 'trigrams')}/cells"
    cells.withColumn("shard", F.pmod(F.xxhash64("cell"), F.lit(SHARDS))).write.parquet(at)
    stored = spark.read.parquet(at).repartition(4 * SHARDS, "shard")
    def step(now: Parameters, k: int):
        def shard(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("cell")  # the same draws whatever the order of rows
            own, n, cell = int(pdf["shard"].iloc[0]), pdf["n"].to_numpy(), pdf["cell"].to_numpy(np.int64)
            found = train_shard(now, cell, n, share, 0.03 * 0.4**k, STEPS, 100 * k + own)
            return pd.DataFrame({"shard": [own], "n": [float(n.sum())], "p": [found.flat()]})

        return shard

    model = Parameters.start(share)
    for k in range(ROUNDS):
        found = stored.groupBy("shard").applyInPandas(step(model, k), "shard long, n double, p array<double>").toPandas()
        if len(found):
            found = found.sort_values("shard")
            model = Parameters.of(np.average(np.stack(found["p"]), axis=0, weights=found["n"]))
    return model


@dataclass
class Model:
    parameters: Parameters
    given: list[bytes]
    given_n: np.ndarray
    class_mass: np.ndarray  # sum of (count + 0.5) and 0.5 for the unknown, by class
    tokens: int
    distinct: int
    texts: int
    key: str = field(default_factory=lambda: uuid4().hex)


_tables: dict[str, np.ndarray] = {}


def _table_of(model: Model) -> np.ndarray:
    """The normalised table, made once per worker process."""
    if model.key not in _tables:
        _tables.clear()
        _tables[model.key] = model.parameters.log10_table()
    return _tables[model.key]


def fit(train_docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the stored word counts of the training texts."""
    spark = train_docs.sparkSession
    at = f"{shared_dir(spark, 'word-counts')}/counts"
    word_counts(train_docs).write.parquet(at)
    counts = spark.read.parquet(at)
    texts = train_docs.count()
    total = counts.agg(F.sum("n"), F.count("*")).first()
    tokens, distinct = (total[0] or 0) + texts, total[1] + (texts > 0)
    top = counts.orderBy(F.desc("n"), "word").limit(SENT_WORDS).toPandas()
    given = [bytes(w) for w in top["word"]]
    singles = CLASSES - SHAPES - 1
    single = set(given[:singles])

    def masses(batches):
        mass = np.zeros(CLASSES)
        for batch in batches:
            for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                if w not in single:
                    mass[singles + 1 + shape(w)] += n + 0.5
        yield pa.RecordBatch.from_arrays([pa.array(range(CLASSES), pa.int32()), pa.array(mass)], ["c", "mass"])

    found = counts.mapInArrow(masses, "c int, mass double").groupBy("c").agg(F.sum("mass").alias("mass")).toPandas()
    mass = np.zeros(CLASSES)
    mass[found["c"]] = found["mass"]
    counted = mass + 0.5
    counted[0] = texts + 0.5
    counted[1 : 1 + len(given[:singles])] = top["n"].to_numpy()[:singles] + 0.5
    share = counted / counted.sum()
    parameters = train(trigram_counts(train_docs, given[:singles]), share)
    return Model(parameters, given, top["n"].to_numpy(np.int64), mass + 0.5, tokens, distinct, texts), counts


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, text -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    schema = "row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, score double, word binary, times long"
    singles = CLASSES - SHAPES - 1

    def local(batches):
        own, table = Words(model.given), _table_of(model)
        sent = len(model.given)
        logs_of = np.log10(model.given_n + 0.5)
        in_class = -np.log10(model.class_mass)
        in_class[: singles + 1] = 0
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            docs_, held = batch.column("doc_id"), batch.column("held_out")
            for at, texts in _batches(batch):
                ids, classes, sizes = own.texts(texts)
                of = np.repeat(np.arange(len(texts)), sizes)
                known = (ids >= 0) & (ids < sent)
                logs = np.zeros(len(ids))
                logs[known] = logs_of[ids[known]]
                end = ids < 0
                logs[end] = np.log10(model.texts + 0.5)
                shaped = classes > singles
                token = table[contexts(classes), classes] + in_class[classes] + np.where(shaped & known, logs, 0)
                rows = row + np.arange(len(texts))
                row += len(texts)
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), docs_.slice(at, n), held.slice(at, n), pa.array(sizes),
                     pa.array(np.bincount(of, known | (end & (model.texts > 0)), n).astype(np.int64)),
                     pa.array(np.bincount(of, logs, n)), pa.array(np.bincount(of, token, n)),
                     pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())],
                    names,
                )
                rare = ids >= sent
                if rare.any():
                    pairs, times = np.unique((of[rare] << 40) | ids[rare], return_counts=True)
                    words = list(map(own.names.__getitem__, (pairs & ((1 << 40) - 1)).tolist()))
                    m = len(pairs)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[pairs >> 40]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()),
                         *(pa.nulls(m, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())),
                         pa.array(words, pa.binary()), pa.array(times.astype(np.int64))],
                        names,
                    )

    names = [x.split()[0] for x in schema.split(", ")]
    at = f"{shared_dir(spark, 'scored')}/rows"
    docs.select(F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(local, schema).write.parquet(at)
    stored = spark.read.schema(schema).parquet(at)
    rare = stored.where("word IS NOT NULL").select("row", "word", "times")
    met = rare.join(counts.select("word", "n"), "word", "left")
    sums = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
    )
    base = np.log10(model.tokens + 0.5 * (model.distinct + 1))
    more = F.coalesce("more", F.lit(0.0))
    return (
        stored.where("word IS NULL")
        .join(sums, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(model.tokens).cast("long").alias("train_tokens"),
            (F.col("logs") + more - F.col("n_tokens") * F.lit(float(base))).alias("base_score"),
            (F.col("score") + more).alias("score"),
        )
    )


def scores(docs: DataFrame) -> DataFrame:
    """Every text scored by a model of those whose fold isn't held out."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    model, counts = fit(rows.where("NOT held_out"))
    return score(rows, model, counts)
