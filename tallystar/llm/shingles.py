"""Sets of word shingles as sorted arrays of 64-bit hashes, made for a whole batch of texts at once.

Words are runs without blank, tab, line feed, vertical tab, form feed and carriage return, with A-Z in lower case. The
hash of a word adds up a random number per byte and place; a shingle's hash combines those of its words.
"""

from __future__ import annotations

from functools import cache

import numpy as np

WORDS = 5
PLACES = 64
GOLDEN, SECOND, THIRD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads their bits."""
    x = (x + GOLDEN).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * SECOND
    x = (x ^ (x >> np.uint64(27))) * THIRD
    return x ^ (x >> np.uint64(31))


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    space = np.zeros(256, dtype=bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    return lower, space, mixed(np.arange(PLACES * 256, dtype=np.uint64))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and how many words each text has."""
    lower, space, random = _tables()
    content = lower[np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)]
    inside = ~space[content]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    ends = np.flatnonzero(~inside[1:] & inside[:-1]) + 1
    lengths = ends - starts
    letters = content[inside]
    firsts = np.append(0, np.cumsum(lengths)[:-1])
    place = np.arange(len(letters)) - np.repeat(firsts, lengths)
    value = random[(place % PLACES) * 256 + letters]
    if lengths.max() > PLACES:
        value = value * (2 * (place // PLACES) + 1).astype(np.uint64)
    hashes = mixed(np.add.reduceat(value, firsts) + lengths.astype(np.uint64))
    borders = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return hashes, np.diff(np.searchsorted(starts, borders))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct shingles of each text in ascending order; a text of fewer words is one shingle, without words none."""
    hashes, counts = words(texts)
    joined = hashes.copy()
    for k in range(1, WORDS):
        joined[:-k] = joined[:-k] * THIRD + hashes[k:]
    joined = mixed(joined)
    sets, start = [], 0
    for n in counts.tolist():
        if n >= WORDS:
            sets.append(np.unique(joined[start : start + n - WORDS + 1]))
        elif n:
            whole = np.array([n], dtype=np.uint64)
            for h in hashes[start : start + n]:
                whole = mixed(whole * THIRD ^ h)
            sets.append(whole)
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
        start += n
    return sets


def digest(shingles: np.ndarray) -> int:
    """A number that depends on the whole set, in the range of a long."""
    spread = mixed(shingles)
    parts = np.array([spread.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(spread)) if len(spread) else 0])
    return int(mixed(parts.astype(np.uint64) + np.array([0, 1], dtype=np.uint64)).sum(dtype=np.uint64).view(np.int64))
