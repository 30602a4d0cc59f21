"""A byte-level BPE vocabulary file of the ``tokenizers`` library, and the chunks that texts are cut into.

A chunk is a run of white space with the run of other characters after it. No pre-token crosses a chunk's borders, so
what is known of a chunk holds wherever it occurs; tasks remember chunks in a table of bounded size. Texts whose blanks
all stand alone are cut at the blanks, which is many times faster: the keys of the table are then what stands between
two blanks and means a chunk with its leading blank. Chunks found otherwise have keys with one more blank in front,
which no key of the first kind has.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import lru_cache
from typing import Any

import numpy as np
import regex

# Unicode white space, and the byte-level pre-token pattern over it.
WHITE = r"\t-\r \x85\xa0  -     　"
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
_chunks = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall
_blank_beside_white = re.compile(f" [{WHITE}]|[{WHITE}] ").search
_pre_tokens: Callable[[str], list[str]] = regex.compile(PRE_TOKEN).findall

# Beyond this, a task forgets the chunks that its last texts did not hold. Keys of more characters than the second number
# are forgotten with their batch, for a chunk may be a whole text.
MEMO_BYTES = 64 << 20
LONG_KEY = 256
_ENTRY = 200  # bytes of an entry besides its key


def chunk_keys(text: str) -> list[str]:
    """The keys of the text's chunks, in order."""
    if _blank_beside_white(text):
        return [" " + c for c in _chunks(text)]
    keys = text.split(" ")
    if keys[0]:
        keys[0] = " " + keys[0]
        return keys
    return keys[1:]


def pre_tokens(key: str) -> list[str]:
    """The pre-tokens of the chunk that a key stands for. Most are a word: one pre-token."""
    chunk = key[1:] if key[:1] == " " else " " + key
    return [chunk] if key.isalpha() else _pre_tokens(chunk)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is printable, else the next free one from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    byte_ids: list[int]  # id of each single byte
    merges: dict[tuple[int, int], tuple[int, int]]  # pair of ids: rank, id of the merged symbol
    spelled: dict[int, bytes]  # bytes of each id
    special: dict[str, int]  # strings that are one token wherever they occur

    def segments(self, text: str) -> list[str]:
        """The text cut at special strings, which stay as segments of their own."""
        if not any(s in text for s in self.special):
            return [text]
        longest_first = sorted(self.special, key=len, reverse=True)
        return [s for s in re.split(f"({'|'.join(map(re.escape, longest_first))})", text) if s]


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    """Reads the file once per process. Raises for kinds of files whose meaning differs."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, kind = content["model"], content["pre_tokenizer"]
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges"))
    if not plain or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or content["normalizer"]:
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in content["added_tokens"]):
        raise ValueError(f"{path} has added tokens that take in their surroundings")
    ids, symbols = model["vocab"], byte_symbols()
    byte_of = {s: b for b, s in enumerate(symbols)}
    merges = {}
    for rank, (left, right) in enumerate(model["merges"]):
        merges[ids[left], ids[right]] = rank, ids[left + right]
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    spelled = {i: bytes(byte_of[c] for c in s) for s, i in ids.items()}
    return Vocabulary([ids[s] for s in symbols], merges, spelled | {i: s.encode() for s, i in special.items()}, special)


class RankTable:
    """Ranks and merged ids of pairs, looked up for whole arrays."""

    NONE = np.iinfo(np.int64).max

    def __init__(self, vocabulary: Vocabulary):
        pairs = np.array(list(vocabulary.merges), dtype=np.int64)
        values = np.array(list(vocabulary.merges.values()), dtype=np.int64)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], values[order, 0], values[order, 1]
        self.of_rank = {int(r): (int(a), int(b), int(m)) for (a, b), (r, m) in zip(pairs, values, strict=True)}

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; rank ``NONE`` if it never merges."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], self.NONE), self.merged[at]


class Memo:
    """What is known of chunks, by key, for one task. ``solve`` works out those that are new, many at a time."""

    def __init__(self, solve: Callable[[list[str]], dict[str, Any]]):
        self.solve, self.known = solve, {}
        self.size, self.long = 0, list[str]()

    def learn(self, keys: Iterable[list[str]]) -> dict[str, Any]:
        """A table that holds all the keys, and others while they are few."""
        found = set[str]().union(*keys)
        for key in self.long:
            self.known.pop(key, None)
        if self.size > MEMO_BYTES:
            self.known = {c: v for c, v in self.known.items() if c in found}
            self.size = sum(map(len, self.known)) + _ENTRY * len(self.known)
        new = list(found.difference(self.known))
        self.known.update(self.solve(new))
        self.size += sum(map(len, new)) + _ENTRY * len(new)
        self.long = [c for c in new if len(c) > LONG_KEY]
        return self.known
