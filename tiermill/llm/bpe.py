"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A sequence of tokens is what the merges would produce exactly if each two neighbours are. So the encoder walks over a word
with the longest token that matches and is compatible with the token before it, and steps back where it gets
stuck. A position from which nothing led to the end is not tried again, which keeps the walk linear.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tiermill.llm.common import extended
from tiermill.llm.vocabulary import SPLIT, Vocabulary, parsed, share

# Words a worker remembers with their ids, and pairs of tokens; all are forgotten when it is full.
REMEMBERED_WORDS = 200_000
REMEMBERED_PAIRS = 300_000
# Texts encoded or decoded before they are handed on.
TEXTS_AT_ONCE = 256
# Ids decoded at once.
DECODED_IDS = 1 << 17
NEVER = 1 << 62


class _Remembered(dict):
    """Word -> ids, encoded when first asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word):
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = ids = self.encode(word)
        return ids


class Encoder:
    """Encodes and decodes texts; one per worker and vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.merges = {pair: rank for pair, (rank, _) in vocabulary.merges.items()}
        self.split_of: dict[int, tuple[int, int]] = {}
        for pair, (_, merged) in vocabulary.merges.items():
            if merged in self.split_of:
                raise ValueError(f"token {merged} has two merges")
            self.split_of[merged] = pair
        self._check_order()
        self.strings: dict[int, str] = {}
        self.prefixes: dict[int, int | None] = {}
        self.matches = ahocorasick.Automaton()
        for i, token in vocabulary.tokens.items():
            if i in self.split_of or len(token) == 1:
                self.strings[i] = token.decode("latin-1")
                self.matches.add_word(self.strings[i], i)
        self.matches.make_automaton()
        if {token for token in vocabulary.tokens.values() if len(token) == 1} != {bytes([b]) for b in range(256)}:
            raise ValueError("the vocabulary lacks some byte")
        self.lengths = {i: len(token) for i, token in self.strings.items()}
        self.longest = max(self.lengths.values())
        self.right_edges: dict[int, list[tuple[int, int]]] = {}
        self.left_edges: dict[int, list[tuple[int, int]]] = {}
        self.fitting: dict[tuple[int, int], bool] = {}
        self.remembered = _Remembered(self._word)
        self.words = regex.compile(SPLIT).findall
        self.special = vocabulary.special
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self._offsets(vocabulary)

    def _check_order(self) -> None:
        """Every merge must come after the merges of its parts, as training makes them."""
        for pair, rank in self.merges.items():
            for part in pair:
                if part in self.split_of and self.merges[self.split_of[part]] >= rank:
                    raise ValueError(f"merge {rank} uses token {part} before it exists")

    def _edges(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at one end of ``token`` while it is built, each with the rank at which it is merged on."""
        known = self.right_edges if side else self.left_edges
        if token not in known:
            edges, at, until = [], token, NEVER
            while True:
                edges.append((at, until))
                if at not in self.split_of:
                    break
                until = self.merges[self.split_of[at]]
                at = self.split_of[at][side]
            known[token] = edges
        return known[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` beside each other: an entry of the pair table.

        They would not if, at some time, the token then at the right end of ``left`` and the one then at the left end
        of ``right`` were merged. Of equal ranks the one further left is merged first.
        """
        fitting = self.fitting.get((left, right))
        if fitting is None:
            if len(self.fitting) >= REMEMBERED_PAIRS:
                self.fitting.clear()
            fitting = True
            for x, x_until in self._edges(left, 1):
                for y, y_until in self._edges(right, 0):
                    rank = self.merges.get((x, y), NEVER)
                    if rank < x_until and rank <= y_until and rank < NEVER:
                        fitting = False
            self.fitting[left, right] = fitting
        return fitting

    def _word(self, word: str) -> tuple[int, ...]:
        data = word if word.isascii() else word.encode().decode("latin-1")
        # mostly the longest matches from left to right already fit
        longest = tuple([token for _, token in self.matches.iter_long(data)])
        for i, pair in enumerate(zip(longest, longest[1:])):
            if not (self.fitting[pair] if pair in self.fitting else self.fits(*pair)):
                return self._search(data, list(longest[: i + 1]), longest[i + 1])
        return longest

    def _search(self, data: str, taken: list[int], token: int | None) -> tuple[int, ...]:
        """Go on after ``taken``, with ``token`` as the longest choice, stepping back where nothing fits."""
        lengths, fits = self.lengths, self.fits
        at, end, stuck = sum(lengths[t] for t in taken), len(data), set()
        while at < end:
            while token is not None and (at + lengths[token] in stuck or (taken and not fits(taken[-1], token))):
                token = self._shorter(token)
            if token is None:
                stuck.add(at)
                token = taken.pop()
                at -= lengths[token]
                token = self._shorter(token)
            else:
                taken.append(token)
                at += lengths[token]
                token = next(self.matches.iter_long(data[at : at + self.longest]))[1] if at < end else None
        return tuple(taken)

    def _shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        if token not in self.prefixes:
            word = self.strings[token]
            found = (self.matches.get(word[:n], None) for n in range(len(word) - 1, 0, -1))
            self.prefixes[token] = next((t for t in found if t is not None), None)
        return self.prefixes[token]

    def _ordinary(self, text: str) -> Iterator[int]:
        return chain.from_iterable(map(self.remembered.__getitem__, self.words(text)))

    def encode(self, text: str) -> np.ndarray:
        """Ids of the whole text as 32-bit integers; special strings in it become their ids."""
        if not any(s in text for s in self.special):
            return np.fromiter(self._ordinary(text), "<u4")
        parts = self.specials.split(text)
        ids = ([self.special[p]] if i % 2 else self._ordinary(p) for i, p in enumerate(parts))
        return np.fromiter(chain.from_iterable(ids), "<u4")

    def _offsets(self, vocabulary: Vocabulary) -> None:
        tokens = vocabulary.tokens | {i: s.encode() for s, i in self.special.items()}
        ordered = [tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in ordered], dtype=np.int64)]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        parts = []
        for begin in range(0, len(ids), DECODED_IDS):
            some = ids[begin : begin + DECODED_IDS].astype(np.int64)
            starts = self.offsets[some]
            lengths = self.offsets[some + 1] - starts
            ends = np.cumsum(lengths)
            moved = np.repeat(starts - (ends - lengths), lengths)
            parts.append(self.bytes[moved + np.arange(len(moved))].tobytes())
        return b"".join(parts).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def encoder(data: bytes) -> Encoder:
    return Encoder(parsed(data))


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, TEXTS_AT_ONCE):
            yield batch.slice(begin, TEXTS_AT_ONCE)


def encode_texts(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``ids``: the ids of each whole text as bytes, four to an id, little-endian.

    ``vocabulary`` is the path of the JSON file on the driver. A null text counts as empty and has no ids; repeated rows
    are encoded each; an empty table gives no rows.
    """
    held, keep = share(docs.sparkSession, vocabulary), list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(held.value).encode
        for batch in _few(batches):
            ids = [encode(t.as_py() or "").tobytes() for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ids, pa.binary())], names=[*keep, "ids"])

    narrow = docs.select(*[f"`{c}`" for c in keep], f"`{text}`")
    schema = extended(narrow.select(*[f"`{c}`" for c in keep]).schema, "ids binary")
    return narrow.mapInArrow(run, schema)


def decode_texts(encoded: DataFrame, vocabulary: str, into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ``ids`` as column ``into``; null ids give a null text."""
    held = share(encoded.sparkSession, vocabulary)
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(held.value).decode
        for batch in _few(batches):
            texts = [decode(np.frombuffer(i, "<u4")) if i is not None else None for i in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, into])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(into, T.StringType())]))
