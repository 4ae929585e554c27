"""Best-fit packing of tokenised documents into sequences of fixed length.

Tasks encode documents and cut only those longer than a sequence. Pieces are then dealt
evenly to packers of bounded size by their row number; every packer runs bounded-space
online best fit: a fixed number of bins is open, a bitset has a bit for each free space
for which a bin is open, and when a bin too many would open the fullest is closed.

Defined cases: a null or empty text is one piece holding the end id only. Rows repeating
an id, and null ids, are packed like any other row. An empty table gives an empty result.
Extra columns play no part.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylarder.llm.word_bpe import encoder
from skylarder.session import shared_dir

SEQUENCE = 4096
END_ID = 1
OPEN_BINS = 2048
#: tokens that one packer gets; the number of packers grows with the corpus
PACKER_TOKENS = 1 << 23

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(ids: np.ndarray, size: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids."""
    raw = ids.astype("<u4")
    return [
        (k, at, len(part), zlib.crc32(part.tobytes()))
        for k, at in enumerate(range(0, len(raw), size))
        for part in [raw[at : at + size]]
    ]


def cut(docs: DataFrame, vocabulary: str | None = None, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""

    def encode(batches):
        own = encoder(vocabulary)
        end = np.array([end_id], np.int32)
        for batch in batches:
            texts = batch["text"].tolist()
            for at in range(0, len(texts), 128):
                rows = [
                    (doc, *p)
                    for doc, ids in zip(batch["doc_id"].array[at : at + 128], own.encode(texts[at : at + 128]))
                    for p in pieces_of(np.concatenate([ids, end]), size)
                ]
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
                yield out.astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(encode, PIECES)


class OpenBins:
    """Bins by free space, at most ``limit`` of them; the set bits of ``mask`` are the spaces in use."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit, self.mask, self.open, self.made = size, limit, 0, 0, 0
        self.by_space: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        found = bins.pop()
        if not bins:
            self.mask ^= 1 << space
        self.open -= 1
        return found

    def _put(self, found: int, space: int) -> None:
        if space:
            if not self.by_space[space]:
                self.mask |= 1 << space
            self.by_space[space].append(found)
            self.open += 1

    def add(self, length: int) -> tuple[int, int]:
        """(bin, offset) of an item: the fullest bin with room for it, or a new one."""
        fitting = self.mask >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            found = self._take(space)
        else:
            if self.open == self.limit:
                self._take((self.mask & -self.mask).bit_length() - 1)  # the fullest closes
            found, space = self.made, self.size
            self.made += 1
        self._put(found, space - length)
        return found, self.size - space


def pack(pieces: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS, packer_tokens: int = PACKER_TOKENS) -> DataFrame:
    """``pieces`` (any columns, among them length) with sequence_id and offset; written once to the shared folder."""
    spark = pieces.sparkSession
    at = f"{shared_dir(spark, 'pieces')}/pieces"
    pieces.write.parquet(at)
    stored = spark.read.schema(pieces.schema).parquet(at)
    total = stored.agg(F.sum("length")).first()[0] or 0
    packers = max(1, -(-total // packer_tokens))
    dealt = stored.withColumn("packer", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(packers)))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in stored.schema)}, sequence_id long, offset long"

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        bins = OpenBins(size, open_bins)
        # longest first: the short ones then fill what the long ones have left
        order = np.argsort(-pdf["length"].to_numpy(), kind="stable")
        placed = np.array([bins.add(int(n)) for n in pdf["length"].to_numpy()[order]], np.int64).reshape(-1, 2)
        out = pdf.iloc[order].drop(columns="packer")
        return out.assign(sequence_id=(int(pdf["packer"].iloc[0]) << 32) + placed[:, 0], offset=placed[:, 1])

    return dealt.groupBy("packer").applyInPandas(one, schema)
