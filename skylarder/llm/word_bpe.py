"""Encoding with a public tokenizer that never looks across white space, word by word.

The vocabulary drops white space and ends words itself, so a text's ids are those of its
words in turn. Each distinct word is merged once per worker process and kept in a table
of bounded size; a batch then costs one lookup per word. Latin words are merged by the
vocabulary's ranks; any other word, and any that may hold a special token's string, goes
to the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np

DEFAULT_VOCABULARY = "word_bpe_49k.json"
#: words a worker process remembers; beyond it the table starts anew
MAX_WORDS = 500_000
#: control characters that str.split() takes for white space and the vocabulary does not
_ODD = re.compile("[\x1c-\x1f]")
_BLANK = re.compile(r"[ \t\n\r\x0b\x0c]+")
#: words merged by rank: letters up to U+024F and ASCII, without the sign that opens special tokens
_LATIN = re.compile(r"[!-;=-~À-ÖØ-öø-ɏ]+").fullmatch
#: stands for the end of a word among bytes; never part of UTF-8
_END = b"\xff"

_encoders: dict[tuple[str, bool], "WordEncoder"] = {}


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str | None = None, ordinary: bool = False) -> "WordEncoder":
    """The encoder of this process. ``ordinary``: strings of special tokens are plain text."""
    key = (path or vocabulary_path(), ordinary)
    if key not in _encoders:
        _encoders[key] = WordEncoder(*key)
    return _encoders[key]


def _printable_bytes() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class WordEncoder:
    def __init__(self, path: str, ordinary: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        tail = spec["model"]["end_of_word_suffix"]
        bytes_of = _printable_bytes()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {
            bytes(bytes_of[c] for c in core) + end: rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in special
            for core, end in [(token.removesuffix(tail), _END) if token.endswith(tail) else (token, b"")]
        }
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.merge = tiktoken.Encoding(
            "words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )._core_bpe.encode_single_piece
        self.parts = regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.pool = np.empty(1 << 20, np.int32)
        self.used = 0
        self.starts = np.empty(1 << 17, np.int64)
        self.sizes = np.empty(1 << 17, np.int64)

    def word(self, word: str) -> list[int]:
        """Ids of a word without white space."""
        if word.isascii():
            if "<" in word or not word.isprintable():
                return self.tokenizer.encode(word, add_special_tokens=False).ids
        elif _LATIN(word):
            word = unicodedata.normalize("NFC", word)
        else:
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        word = "".join(map(str.lower, word)) if "İ" in word else word.lower()
        if word.isalpha():
            return self.merge(word.encode() + _END)
        if word[:-1].isalpha():
            return self.merge(word[:-1].encode() + _END) + self.merge(word[-1].encode() + _END)
        return [i for part in self.parts(word) for i in self.merge(part.encode() + _END)]

    def _learn(self, words: list[str]) -> None:
        found = [self.word(w) for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for x in found for i in x), np.int32, int(sizes.sum()))
        at, used = len(self.place), self.used + len(ids)
        if used > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.empty(used, np.int32)])
        if at + len(words) > len(self.starts):
            room = np.empty(at + len(words), np.int64)
            self.starts, self.sizes = (np.concatenate([x[:at], room]) for x in (self.starts, self.sizes))
        self.pool[self.used : used] = ids
        self.sizes[at : at + len(words)] = sizes
        self.starts[at : at + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.place.update(zip(words, range(at, at + len(words))))
        self.used = used

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text."""
        if len(self.place) > MAX_WORDS:
            self._forget()
        split = [[w for w in _BLANK.split(t) if w] if _ODD.search(t) else t.split() for t in texts]
        words = [w for s in split for w in s]
        if not words:
            return [np.empty(0, np.int32) for _ in texts]
        new = [w for w in set(words) if w not in self.place]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(ends[-1])]
        bounds = np.concatenate([[0], ends])[np.cumsum([len(s) for s in split])]
        return np.split(ids, bounds[:-1])
