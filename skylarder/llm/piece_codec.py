"""SentencePiece encoding and decoding with batched numpy Viterbi.

A text's white space is marked as the vocabulary has it; a word with its mark is a unit.
Distinct units of one length advance together, and those over MAX_UNIT characters alone: for each end place and piece length, hashes
of the substrings probe the sorted hashes of the pieces, and vectorised maxima keep the best
score and its backpointer. A character that no piece covers falls back to its bytes. The
best segmentation under the vocabulary's log probabilities is taken (the fewest pieces among
equal scores, then the longest last piece). A vocabulary learned by merges stores ranks
instead; a piece's log probability is then minus the logarithm of its rank (Zipf's law).

Decoding maps ids to pieces, bytes to characters and marks to spaces, and gives back every
text exactly.

Defined cases: a null text is the empty text, which has no ids. Text that is not valid
UTF-8 can't come from Spark. Null and repeated ids are kept as they are; an empty table gives
an empty result; extra columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
#: stands for a mark that a text itself holds, which goes as bytes; no text has a lone surrogate
LITERAL = "\udfff"
#: longest piece, in characters, that is looked for; the vocabulary has none longer
MAX_PIECE = 16
#: longest unit that is encoded beside others of its length and remembered
MAX_UNIT = 64
#: characters of a longer unit whose pieces are looked up at once
WINDOW = 1 << 14
#: units that a worker remembers, and their ids; beyond either it starts anew
MAX_UNITS, MAX_IDS = 500_000, 1 << 23
#: what a character without a piece costs, for each of its bytes
BYTE_SCORE = -100.0
_BASE = np.uint64(0x100000001B3)


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _hash(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of code points."""
    out = np.zeros(codes.shape[0], np.uint64)
    for k in range(codes.shape[1]):
        out = out * _BASE + codes[:, k]
    return out


class Codec:
    """Encoder and decoder of one worker process."""

    def __init__(self, path: str | None = None):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path or vocabulary_path())
        pieces = [(model.id_to_piece(i), i) for i in range(model.get_piece_size())]
        usable = [(p, i) for p, i in pieces if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        log_probability = np.array([model.get_score(i) for _, i in pieces])
        usable = [(p, i) for p, i in usable if log_probability[i] > -1e6 or p == SPACE]
        log_probability = np.maximum(log_probability, -float(len(pieces)))
        if all(float(x).is_integer() for x in log_probability):  # ranks of merges: by Zipf's law their logarithms
            log_probability = -np.log(2 - np.minimum(log_probability, 0))
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        raw_of = {i: p.replace(SPACE, " ").encode("utf-8", "surrogatepass") for p, i in usable}
        raw_of |= {int(i): bytes([b]) for b, i in enumerate(self.bytes)}
        raw = [raw_of.get(i, b"") for i in range(len(pieces))]
        self.raw_table = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_sizes = np.array([len(r) for r in raw], np.int64)
        self.raw_starts = np.cumsum(self.raw_sizes) - self.raw_sizes
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in range(1, MAX_PIECE + 1):
            own = [(p, i) for p, i in usable if len(p) == n]
            if own:
                codes = np.array([[ord(c) for c in p] for p, _ in own], np.uint64)
                ids = np.array([i for _, i in own], np.int32)
                scores = log_probability[ids]
                keys = _hash(codes)
                order = np.argsort(keys, kind="stable")
                self.by_length[n] = keys[order], codes[order], ids[order], scores[order]
        self._forget()

    def _forget(self) -> None:
        #: number of each unit met, and of each word by itself; the ids of unit k are pool[starts[k]:][:sizes[k]]
        self.number: dict[str, int] = {}
        self.of_word: dict[str, int] = {}
        self.pool, self.used = np.empty(1 << 20, np.int32), 0
        self.starts, self.sizes = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)
        literal = self.bytes[list(SPACE.encode())]
        self._keep([LITERAL], literal, np.array([len(literal)]))

    def _keep(self, units: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        at, need = len(self.number), self.used + len(ids)
        if need > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.empty(need, np.int32)])
        if at + len(units) > len(self.starts):
            room = np.empty(at + len(units), np.int64)
            self.starts, self.sizes = (np.concatenate([x[:at], room]) for x in (self.starts, self.sizes))
        self.pool[self.used : need] = ids
        self.sizes[at : at + len(units)] = sizes
        self.starts[at : at + len(units)] = self.used + np.cumsum(sizes) - sizes
        self.number.update(zip(units, range(at, at + len(units))))
        self.used = need

    def viterbi(self, units: np.ndarray) -> list[np.ndarray]:
        """Ids of units of one length, given as rows of code points."""
        ids, sizes = self.best(units)
        return np.split(ids, np.cumsum(sizes)[:-1])

    def best(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units of one length, one unit after the other, and how many each has."""
        m, n = units.shape
        # one row for each place, so that a step works on whole rows
        units = np.ascontiguousarray(units.T)
        codes = units.astype(np.uint64)
        best = np.full((n + 1, m), -np.inf)
        best[0] = 0
        count, back, piece = np.zeros((n + 1, m), np.int32), np.ones((n + 1, m), np.int32), np.full((n + 1, m), -1, np.int32)
        width = np.where(units < 0x80, 1, np.where(units < 0x800, 2, np.where(units < 0x10000, 3, 4)))
        # prefix hashes give the hash of any substring by one multiplication
        prefix = np.zeros((n + 1, m), np.uint64)
        for k in range(n):
            prefix[k + 1] = prefix[k] * _BASE + codes[k]
        powers = np.array([pow(int(_BASE), k, 1 << 64) for k in range(MAX_PIECE + 1)], np.uint64)
        for end in range(1, n + 1):
            best[end] = best[end - 1] + BYTE_SCORE * width[end - 1]
            count[end] = count[end - 1] + width[end - 1]
            for length, (keys, texts, ids, scores) in self.by_length.items():
                if length > end:
                    break
                key = prefix[end] - prefix[end - length] * powers[length]
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == key)
                if not len(hit):
                    continue
                hit = hit[(texts[at[hit]].T == codes[end - length : end, hit]).all(0)]
                score = best[end - length, hit] + scores[at[hit]]
                pieces = count[end - length, hit] + 1
                # later lengths are longer, so they win a tie
                wins = (score > best[end, hit]) | ((score == best[end, hit]) & (pieces <= count[end, hit]))
                won = hit[wins]
                best[end, won], count[end, won] = score[wins], pieces[wins]
                back[end, won], piece[end, won] = length, ids[at[won]]
        # all units walk their backpointers together
        at, todo = np.full(m, n), np.arange(m)
        whose, found, ends = [], [], []
        while len(todo):
            end = at[todo]
            whose.append(todo)
            found.append(piece[end, todo])
            ends.append(end)
            at[todo] = end - back[end, todo]
            todo = todo[at[todo] > 0]
        unit, ids, end = np.concatenate(whose), np.concatenate(found), np.concatenate(ends)
        order = np.lexsort((end, unit))
        unit, ids, end = unit[order], ids[order], end[order]
        sizes = np.where(ids >= 0, 1, width[end - 1, unit])
        out = np.repeat(ids, sizes)
        firsts = np.cumsum(sizes) - sizes
        for k in np.flatnonzero(ids < 0).tolist():  # characters without a piece go as bytes
            raw = chr(units[end[k] - 1, unit[k]]).encode("utf-8", "surrogatepass")
            out[firsts[k] : firsts[k] + len(raw)] = self.bytes[list(raw)]
        return out.astype(np.int32), np.bincount(unit, sizes, m).astype(np.int64)

    def viterbi_long(self, unit: str) -> np.ndarray:
        """Ids of one unit of any length: pieces are looked up by windows, scores carry over their borders."""
        units = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), np.uint32)
        n, codes = len(units), units.astype(np.uint64)
        width = np.where(units < 0x80, 1, np.where(units < 0x800, 2, np.where(units < 0x10000, 3, 4))).tolist()
        back, piece = np.ones(n + 1, np.int8), np.full(n + 1, -1, np.int32)
        # best score and number of pieces of the last MAX_PIECE places, by place modulo ring
        ring = MAX_PIECE + 1
        best, count = [0.0] * ring, [0] * ring
        for at in range(0, n, WINDOW):
            stop = min(n, at + WINDOW)
            found: list[list[tuple[int, float, int]]] = [[] for _ in range(stop - at)]
            for length, (keys, texts, ids, scores) in self.by_length.items():
                # pieces that end inside the window
                part = codes[max(0, at + 1 - length) : stop]
                if len(part) < length:
                    continue
                own = np.lib.stride_tricks.sliding_window_view(part, length)
                key = _hash(own)
                k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = np.flatnonzero(keys[k] == key)
                hit = hit[(texts[k[hit]] == own[hit]).all(1)]
                ends = hit + (max(0, at + 1 - length) + length - 1 - at)
                for e, score, i in zip(ends.tolist(), scores[k[hit]].tolist(), ids[k[hit]].tolist()):
                    found[e].append((length, score, i))
            for end, options in enumerate(found, at + 1):
                w, old = width[end - 1], (end - 1) % ring
                top, pieces, won = best[old] + BYTE_SCORE * w, count[old] + w, None
                for option in options:
                    start = (end - option[0]) % ring
                    score, c = best[start] + option[1], count[start] + 1
                    if score > top or (score == top and c <= pieces):
                        top, pieces, won = score, c, option
                best[end % ring], count[end % ring] = top, pieces
                if won:
                    back[end], piece[end] = won[0], won[2]
        out: list[int] = []
        end = n
        while end:
            if piece[end] >= 0:
                out.append(int(piece[end]))
            else:
                out.extend(self.bytes[list(unit[end - 1].encode("utf-8", "surrogatepass"))][::-1].tolist())
            end -= int(back[end])
        return np.array(out[::-1], np.int32)

    def _learn(self, units: list[str]) -> None:
        by_size: dict[int, list[str]] = {}
        for u in units:
            by_size.setdefault(len(u), []).append(u)
        for n, own in by_size.items():
            if n > MAX_UNIT:
                found = [self.viterbi_long(u) for u in own]
                self._keep(own, np.concatenate(found), np.array([len(x) for x in found]))
                continue
            for k in range(0, len(own), 4096):
                part = own[k : k + 4096]
                codes = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), n)
                self._keep(part, *self.best(codes))

    def _numbers(self, texts: list[str]) -> list[list[int]]:
        """The numbers of each text's units; new units are learned first."""
        # without marks of their own, texts are words, looked up as they stand
        plain = [t.split(" ") if t and SPACE not in t else None for t in texts]
        others = [units_of(t) if p is None else None for t, p in zip(texts, plain)]
        words = {w for p in plain if p for w in p if w not in self.of_word}
        units = {SPACE + w: w for w in words}
        new = set(units) | {u for o in others if o for u in o}
        self._learn([u for u in new if u not in self.number])
        self.of_word.update((w, self.number[u]) for u, w in units.items())
        return [list(map((self.of_word if o is None else self.number).__getitem__, p if o is None else o)) for p, o in zip(plain, others)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text."""
        if len(self.number) > MAX_UNITS or self.used > MAX_IDS:
            self._forget()
        numbers = self._numbers(texts)
        at = np.fromiter(chain.from_iterable(numbers), np.int64)
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(sizes.sum())]
        bounds = np.append(0, ends)[np.cumsum([len(n) for n in numbers])]
        return np.split(ids, bounds[:-1])

    def raw(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of the texts of ids, gathered from one table."""
        flat = np.concatenate(ids)
        sizes = self.raw_sizes[flat]
        ends = np.cumsum(sizes)
        table = self.raw_table[np.repeat(self.raw_starts[flat] - ends + sizes, sizes) + np.arange(sizes.sum())].tobytes()
        bounds = np.append(0, ends)[np.cumsum([0] + [len(x) for x in ids])].tolist()
        # the first word has a mark of a space, too
        return [table[a + 1 : b] for a, b in zip(bounds, bounds[1:])]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; their bytes are joined before they become characters."""
        return self.raw([ids])[0].decode("utf-8", "surrogatepass")


def units_of(text: str) -> list[str]:
    """Words with the mark of the space before them, the first too; a mark in the text itself is a unit of its own kind."""
    if not text:
        return []
    out = [SPACE + word for word in text.split(" ")]
    if SPACE not in text:
        return out
    cut: list[str] = []
    for unit in out:
        parts = unit[1:].split(SPACE)
        for k, part in enumerate([SPACE + parts[0], *parts[1:]]):
            if k:
                cut.append(LITERAL)
            if part:
                cut.append(part)
    return cut


@lru_cache(maxsize=2)
def codec(path: str | None = None) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, vocabulary: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with the array column ids."""

    def run(batches):
        own = codec(vocabulary)
        for texts in batches:
            values = texts.tolist()
            yield pd.Series([x for k in range(0, len(values), 128) for x in own.encode(values[k : k + 128])], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn("ids", F.pandas_udf(run, "array<int>")(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))


def summary(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per document: doc_id, n_pieces, ids_crc32 (little-endian 32-bit ids), text_crc32 of the decoded text, round_trip."""

    def run(batches):
        own = codec(vocabulary)
        for batch in batches:
            texts, doc_ids = batch.column("text").to_pylist(), batch.column("doc_id")
            for k in range(0, len(texts), 128):
                part = texts[k : k + 128]
                ids = own.encode(part)
                back = own.raw(ids)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(k, len(part)), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                     pa.array([zlib.crc32(x) for x in back], pa.int64()),
                     pa.array([x.encode("utf-8", "surrogatepass") == y for x, y in zip(part, back)])],
                    ["doc_id", "n_pieces", "ids_crc32", "text_crc32", "round_trip"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, text_crc32 long, round_trip boolean")
