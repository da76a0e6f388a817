"""A byte-level BPE vocabulary, read from the JSON file of a public tokenizer.

The file is read on the driver and travels to the tasks as a broadcast of its few megabytes; workers keep what
they build from it.
"""

from __future__ import annotations

import functools
import json
from dataclasses import dataclass

from pyspark import Broadcast
from pyspark.sql import SparkSession

# Fixed value: how a text is split before any merge.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by id, the merges as (left id, right id) -> (rank, merged id), special strings by id."""

    tokens: dict[int, bytes]
    merges: dict[tuple[int, int], tuple[int, int]]
    special: dict[str, int]

    @classmethod
    def parse(cls, data: bytes) -> Vocabulary:
        file = json.loads(data)
        letters, ids = byte_letters(), file["model"]["vocab"]
        special = {added["content"]: added["id"] for added in file.get("added_tokens", [])}
        tokens = {i: bytes(letters[c] for c in token) for token, i in ids.items() if token not in special}
        merges = {}
        for rank, pair in enumerate(file["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merges[ids[left], ids[right]] = rank, ids[left + right]
        return cls(tokens, merges, special)


def share(spark: SparkSession, path: str) -> Broadcast:
    """The file's bytes for the tasks."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


@functools.lru_cache(maxsize=2)
def parsed(data: bytes) -> Vocabulary:
    return Vocabulary.parse(data)
