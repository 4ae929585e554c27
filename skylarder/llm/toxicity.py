"""Toxicity with noisy-channel deobfuscation.

A word that hides its letters (digits and signs for letters, separators or spaces between
letters, repeated letters) is a lattice of characters; the Viterbi path under a character
trigram model of the corpus is the restored word. The trigrams are counted over all
documents. Restored words and their beginnings that go with the label, by a lower
confidence bound of their log-odds, form a lexicon; a logistic regression over the entries
present in a text gives its score.

Labels are learned from at most ``SAMPLE_ROWS`` labelled rows, the first by a hash of
their id; a fold of ids can be held out. Every whole text is scored.

Defined cases: a null text is the empty text, which has the score of a text without any
entry. Null ids are scored, not held out and never learned from. Rows repeated in
``labels`` count once; labels other than 0 and 1 are left out. Without labels of both
kinds every score is the smoothed share of label 1. Empty tables give empty results.
Extra columns play no part in scores.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: labelled rows learned from, at most
SAMPLE_ROWS = 20_000
#: entries of the lexicon, at most
LEXICON = 8192
FOLDS = 5
#: characters of one lattice
LATTICE = 40
#: words a worker process remembers
MAX_WORDS = 100_000
#: letters of texts whose trigrams are counted at a time, or one text
COUNTED = 1 << 17

# Letters of the character model, and what signs may stand for.
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßéèêëàâçîïôûùœñíóáúì"
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}

SIZE = 64
_INDEX = {c: k + 1 for k, c in enumerate(LETTERS)}
_OTHER = len(LETTERS) + 1
_TABLE = np.zeros(0x250, np.int32)
for _c in range(0x250):
    if chr(_c).isalpha():
        _TABLE[_c] = _INDEX.get(chr(_c), _OTHER)

#: single characters in a row, with one or two signs or spaces between
_SPACED = re.compile(r"(?<!\S)\w(?:[ .\-_*]{1,2}\w){2,}(?![^\s.,;:!?])")
_HIDING = re.compile(r"[^\W\d_][^a-zA-ZÀ-ɏ]+[^\W\d_]|\d[^\W\d_]|[^\W\d_]\d|[@$!|+(€£¡][^\W\d_]|[^\W\d_][@$](?![@$])|([^\W\d_])\1\1")

Costs = np.ndarray


def held_out(id_col: Column, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == fold, F.lit(False))


# --- the character model ------------------------------------------------------


def count_trigrams(texts: list[str]) -> np.ndarray:
    """Counts of letter trigrams inside words; place 0 stands for any non-letter."""
    raw = np.frombuffer(" ".join(texts).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    pad = np.zeros(2, np.int32)
    seq = np.concatenate([pad, np.where(raw < 0x250, _TABLE[np.minimum(raw, 0x24F)], np.int32(0)), pad[:1]])
    a, b, c = seq[:-2], seq[1:-1], seq[2:]
    inside = (b > 0) | (c > 0)
    a = np.where(b == 0, 0, a)
    return np.bincount(((a * SIZE + b) * SIZE + c)[inside], minlength=SIZE**3)


def runs_of(texts: list[str], most: int) -> Iterator[list[str]]:
    """The texts in turn, as many at a time as have at most ``most`` letters together, or one."""
    part: list[str] = []
    size = 0
    for text in texts:
        if part and size + len(text) > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def costs_of(counts: np.ndarray) -> Costs:
    """Negative log probabilities [before last, last, next], backing off to shorter contexts."""
    n = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    two, one = n.sum(0), n.sum((0, 1))
    p = (one + 1) / (one.sum() + SIZE)
    p = (two + 2 * p) / (two.sum(1, keepdims=True) + 2)
    p = (n + 2 * p) / (n.sum(2, keepdims=True) + 2)
    return -np.log(p)


def character_model(docs: DataFrame, text_col: str = "text") -> Costs:
    """The model over all texts; tasks send sums by trigram, at most 64^3 rows come back."""

    def count(batches):
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for part in runs_of(batch["text"].tolist(), COUNTED):
                total += count_trigrams(part)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"trigram": seen, "n": total[seen]})

    texts = docs.select(F.coalesce(text_col, F.lit("")).alias("text"))
    found = texts.mapInPandas(count, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SIZE**3, np.int64)
    counts[found["trigram"]] = found["n"]
    return costs_of(counts)


def _options(word: str) -> list[list[tuple[str, float]]]:
    """For each character the letters it may stand for, with the channel's cost; '' skips it."""
    out = []
    for k, c in enumerate(word):
        if c.isalpha():
            own = [(c, 0.0)]
            if k and word[k - 1] == c:
                long = word[k - 2 : k + 1] == c * 3 or word[k - 1 : k + 2] == c * 3
                own.append(("", 0.3 if long else 4.0))
        else:
            own = [(x, 1.0) for x in STANDS_FOR.get(c, "")]
            own.append(("", 7.0 if own else (2.0 if c.isdigit() else 0.2)))
        out.append(own)
    return out


def restore(word: str, costs: Costs) -> str:
    """The cheapest reading of a word: channel costs plus the character model's."""
    states = {(0, 0): (0.0, "")}
    for own in _options(word):
        new: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in states.items():
            for letter, extra in own:
                if letter:
                    i = _INDEX.get(letter, _OTHER)
                    key, now = (b, i), cost + extra + costs[a, b, i]
                else:
                    key, now = (a, b), cost + extra
                if key not in new or now < new[key][0]:
                    new[key] = (now, text + letter)
        states = new
    return min((cost + costs[a, b, 0], text) for (a, b), (cost, text) in states.items())[1]


# --- entries of a text --------------------------------------------------------


def _trim(word: str) -> str:
    """Without marks around it: runs of signs, and single signs that stand for no letter."""
    core = word.strip(".,;:?*%&#-_'\"()[]{}<>=/\\~^`«»“”‘’…")
    core = re.sub(r"^(\W)\1+|(\W)\2+$", "", core)
    return core.rstrip("!|+(")


def lattices(core: str) -> list[str]:
    """The word itself; of a word over LATTICE characters, longer runs become three, and what is still longer goes by halves that overlap."""
    if len(core) <= LATTICE:
        return [core]
    core = re.sub(r"(.)\1{2,}", r"\1\1\1", core)
    return [core[at : at + LATTICE] for at in range(0, max(1, len(core) - LATTICE // 2), LATTICE // 2)]


def readings(word: str, costs: Costs) -> set[str]:
    """A word in lower case as it stands and, if it hides letters, restored."""
    word = unicodedata.normalize("NFKC", word).lower()
    if word.isalpha():
        core = word
    else:
        core = _trim("".join(c for c in word if unicodedata.category(c) != "Cf"))
    found = {core} if core.isalpha() else set()
    if _HIDING.search(core):
        found.update(restore(part, costs) for part in lattices(core))
    return {x for x in found if len(x) > 1}


def entries(reading: str) -> list[str]:
    """The reading itself and its beginnings of four to six letters, which carry a stem."""
    return [reading] + [f"{reading[:n]}-" for n in (4, 5, 6) if len(reading) > n]


class Reader:
    """Finds the entries of texts; ``wanted`` limits them to a lexicon."""

    def __init__(self, costs: Costs, wanted: dict[str, int] | None = None):
        self.costs, self.wanted, self.known = costs, wanted, {}

    def of_word(self, word: str) -> tuple:
        found = {e for r in readings(word, self.costs) for e in entries(r)}
        if self.wanted is not None:
            return tuple(self.wanted[e] for e in found if e in self.wanted)
        return tuple(found)

    def of_run(self, run: str) -> tuple:
        """Of letters without word boundaries: the entries at every start, once there is a lexicon."""
        found = set(self.of_word(run))
        if self.wanted is not None:
            for r in readings(run, self.costs):
                found.update(self.wanted[e] for at in range(1, len(r)) for e in self.at(r, at) if e in self.wanted)
        return tuple(found)

    def at(self, reading: str, at: int) -> list[str]:
        """Words of up to LATTICE letters that begin at a place, and the beginnings of four to six letters there."""
        rest = reading[at : at + LATTICE]
        return [rest[:n] for n in range(4, len(rest) + 1)] + entries(rest)[1:]

    def of_text(self, text: str) -> set:
        if len(self.known) > MAX_WORDS:
            self.known = {}
        known, out = self.known, set()
        words = set(text.split())
        words.update(re.sub(r"[ .\-_*]", "", m.group()) + "\0" for m in _SPACED.finditer(text))
        for word in words:
            got = known.get(word)
            if got is None:
                # letters given one by one are a lattice too, even when none is changed
                run = word[-1] == "\0" or len(word) > LATTICE
                got = known[word] = self.of_run(word.rstrip("\0")) if run else self.of_word(word)
            if got:
                out.update(got)
        return out


# --- the classifier -----------------------------------------------------------


@dataclass
class Model:
    costs: Costs
    lexicon: dict[str, int]
    weights: np.ndarray
    bias: float


def lexicon_of(counts: pd.DataFrame, positive: int, negative: int, least: float = 1.5) -> list[str]:
    """Entries whose log-odds of the label are above ``least`` with 95 % confidence, surest first."""
    p, n = counts["p"].to_numpy() + 0.5, counts["n"].to_numpy() + 0.5
    odds = np.log(p / (positive - p + 1)) - np.log(n / (negative - n + 1))
    low = odds - 1.64 * np.sqrt(1 / p + 1 / n)
    order = np.lexsort((counts["entry"].to_numpy(), -low))
    return [counts["entry"].iat[k] for k in order[:LEXICON] if low[k] > least]


def regress(rows: list[list[int]], labels: np.ndarray, size: int, rounds: int = 300, decay: float = 1e-3):
    """Weights and bias of a logistic regression over present entries, by Adam on the whole sample."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    what = np.fromiter((k for r in rows for k in r), np.int64, len(at))
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    w = np.zeros(size + 1)
    w[-1] = np.log(share / (1 - share))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1) if 0 < labels.sum() < len(labels) else ():
        z = np.bincount(at, w[what], len(rows)) + w[-1]
        miss = (1 / (1 + np.exp(-z)) - labels) / len(labels)
        g = np.append(np.bincount(what, miss[at], size), miss.sum())
        g[:-1] += decay * w[:-1] / max(1, len(labels)) ** 0.5
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold: int | None = 0, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from ``labels`` (doc_id, ``label``), leaving out the fold of ids ``fold``."""
    spark = docs.sparkSession
    costs = character_model(docs)
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    if fold is not None:
        known = known.where(~held_out(F.col("doc_id"), fold))
    sample = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)
    # at most sample_rows rows, so small enough to send
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.repartition(4 * spark.sparkContext.defaultParallelism, F.xxhash64("doc_id"))

    def count(batches):
        reader = Reader(costs)
        for batch in batches:
            # counted text by text, so that a batch holds each entry once
            seen: tuple[Counter, Counter] = Counter(), Counter()
            for text, y in zip(batch["text"], batch["label"]):
                seen[y].update(reader.of_text(text))
            entry = list(seen[0] | seen[1])
            yield pd.DataFrame({"entry": entry, "p": [seen[1][e] for e in entry], "n": [seen[0][e] for e in entry]}).astype({"p": "int64", "n": "int64"})

    distinct = texts.dropDuplicates(["text", "label"]).select("text", "label").persist()
    try:
        sizes = {r["label"]: r["count"] for r in distinct.groupBy("label").count().collect()}
        positive, negative = sizes.get(1, 0), sizes.get(0, 0)
        counts = distinct.mapInPandas(count, "entry string, p long, n long").groupBy("entry")
        counts = counts.agg(F.sum("p").alias("p"), F.sum("n").alias("n")).where("p >= 3 AND p * 2 > n")
        best = counts.orderBy(F.desc(F.col("p") / (F.col("n") + 1.0)), "entry").limit(4 * LEXICON).toPandas()
        lexicon = {e: k for k, e in enumerate(lexicon_of(best, positive, negative))}

        def present(batches):
            reader = Reader(costs, lexicon)
            for batch in batches:
                rows = [sorted(reader.of_text(t)) for t in batch["text"]]
                yield pd.DataFrame({"label": batch["label"], "found": rows})

        rows = distinct.mapInPandas(present, "label int, found array<int>").toPandas()
    finally:
        distinct.unpersist()
    rows["key"] = [tuple(x) for x in rows["found"]]
    rows = rows.sort_values(["key", "label"])  # the same sums whatever the order of tasks
    weights, bias = regress([list(x) for x in rows["key"]], rows["label"].to_numpy(float), len(lexicon))
    return Model(costs.astype(np.float32), lexicon, weights, bias)


def _scorer(model: Model):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(model.costs, model.lexicon)
        for texts in batches:
            z = [model.bias + model.weights[list(reader.of_text(t))].sum() for t in texts]
            yield pd.Series(1 / (1 + np.exp(-np.array(z, float))))

    # the types as objects: Spark reads them to see that batches come as an iterator
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return run


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a column toxicity, 0 to 1; all columns and rows are kept."""

    toxicity = F.pandas_udf(_scorer(model), "double")
    return docs.withColumn("toxicity", toxicity(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))


def scores(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    found = score(docs.select("doc_id", "text"), fit(docs, labels, label))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )
