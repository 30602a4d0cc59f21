"""Alignment of the tokens of two tokenizers by merge-path partitioning.

Both tokenizers cover the same bytes: a blank and the text. Their tokens' end offsets are two sorted arrays, and merging
them visits every overlap once. The merge is divided along its diagonals: where a diagonal of the merge matrix crosses the
path is found by binary search, all diagonals at once, so the pieces between diagonals have equal work whatever the texts.
All pieces advance in step, one merged end each; a piece emits the overlaps it passes and counts the places where both
sides end. Sums of those counts over the pieces before it number the groups, so a group that goes over a border is whole.

Encoding is cut into units, a run of blanks with what follows it up to the next run; no token of either vocabulary
crosses a unit's border (``Pair`` checks it), so each task encodes a unit once, with the public libraries, and remembers it
while it holds fewer than ``MEMO_TOKENS``.

How many documents link a pair of ids is counted in Spark, once per document and pair; the counts are broadcast while
there are at most ``BROADCAST_PAIRS`` of them, and joined by a shuffle otherwise.

Defined results: a text that is null or empty, or whose tokens do not spell it on either side (U+2581 in it does not come
back as it was), has no tokens: all numbers are 0, the groups are null. Special strings in texts are plain text. Rows with
equal ids are aligned and counted one by one. A long text is worked on in parts of about ``PART_BYTES``, cut between
units. An empty table gives no rows. Input columns of the names that are added give way to them.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallystar.llm.common import replacing, texts, with_columns
from tallystar.llm.vocabulary import WHITE, byte_symbols
from tallystar.scratch import stage

PIECE = 128
PART_BYTES = 2 << 20
RUN_CHARS = 1 << 14
MEMO_TOKENS = 1 << 20
BROADCAST_PAIRS = 1 << 20
BLANK = "▁"  # stands for a blank in the pieces of side B
NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
LINKS = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType(), False) for n in "abn"]), False)
_blank_beside_white = re.compile(f" [{WHITE}]|[{WHITE}] ").search
_ends_white = re.compile(f"[{WHITE}]\\Z").search
_unit_borders = re.compile(f"(?<=[^{WHITE}])(?= )").split
Lists = tuple[np.ndarray, np.ndarray]  # the ids of several lists one after the other, and the size of each list


# ---- merge path ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Merged:
    """Overlaps as places in the two arrays, and the number of the group of each token, from 0."""

    left: np.ndarray
    right: np.ndarray
    group_of_a: np.ndarray
    group_of_b: np.ndarray


def diagonal_cuts(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first ``d`` of the merged ends, for each diagonal ``d``; ``a`` goes first on ties."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (low < high).any():
        open_ = low < high
        middle = (low + high) // 2
        at_b = np.clip(diagonals - 1 - middle, 0, len(b) - 1)
        taken = a[np.minimum(middle, len(a) - 1)] <= b[at_b]
        low = np.where(open_ & taken, middle + 1, low)
        high = np.where(open_ & ~taken, middle, high)
    return low


def merge(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> Merged:
    """Overlaps and groups of two strictly ascending arrays of ends that have the same last end."""
    size = len(a) + len(b)
    borders = np.minimum(np.arange(0, size + piece, piece), size)
    in_a = diagonal_cuts(a, b, borders)
    i, j = in_a[:-1].copy(), (borders - in_a)[:-1]
    work = np.diff(borders)
    ends_a, ends_b = np.append(a, np.iinfo(np.int64).max), np.append(b, np.iinfo(np.int64).max)
    left = np.full((len(i), piece), -1, dtype=np.int32)
    right = np.zeros((len(i), piece), dtype=np.int32)
    group_of_a, group_of_b = np.zeros(len(a) + 1, dtype=np.int64), np.zeros(len(b) + 1, dtype=np.int64)
    ties = np.zeros(len(i), dtype=np.int64)
    for step in range(piece):
        on = step < work
        end_a, end_b = ends_a[i], ends_b[j]
        takes_a = on & (end_a <= end_b)
        takes_b = on & (end_a > end_b)
        closed = (i > 0) & (ends_a[i - 1] == end_b)  # this end of ``b`` was one of ``a`` as well
        emits = takes_a | (takes_b & ~closed)
        left[emits, step], right[emits, step] = i[emits], j[emits]
        group_of_a[i[takes_a]] = ties[takes_a]
        group_of_b[j[takes_b]] = ties[takes_b] - closed[takes_b]
        ties += takes_a & (end_a == end_b)
        i += takes_a
        j += takes_b
    before = np.append(0, np.cumsum(ties)[:-1])
    group_of_a = group_of_a[:-1] + np.repeat(before, np.diff(in_a))
    group_of_b = group_of_b[:-1] + np.repeat(before, np.diff(borders - in_a))
    kept = left >= 0
    return Merged(left[kept], right[kept], group_of_a, group_of_b)


# ---- tokens -------------------------------------------------------------------------------------------------


class Pair:
    """The two tokenizers, with the number of bytes of each of their ids."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark decides how many cores a task has
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {s: n for n, s in enumerate(byte_symbols())}
        plain = {t.content for t in self.a.get_added_tokens_decoder().values()}
        size_a = max(self.a.get_vocab().values()) + 1
        self.bytes_a = [b""] * size_a
        for token, n in self.a.get_vocab().items():
            self.bytes_a[n] = token.encode() if token in plain else bytes(byte_of[c] for c in token)
        self.bytes_b = [self._spelled(n) for n in range(self.b.get_piece_size())]
        if any(re.search(f"[^{BLANK}]{BLANK}", self.b.id_to_piece(n)) for n in range(len(self.bytes_b))):
            raise ValueError(f"{path_b} has pieces that go on after a blank")
        self.sizes_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.lone = self.b.piece_to_id(BLANK)
        # The ids as they stand in the text of a group, with what follows them inside it and at its end.
        self.shown_a = [f"{n}{end}" for n in range(size_a) for end in ",|"]
        self.shown_b = [f"{n}{end}" for n in range(len(self.bytes_b)) for end in ",;"]

    def _spelled(self, n: int) -> bytes:
        piece = self.b.id_to_piece(n)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(n) else piece.replace(BLANK, " ").encode()

    def encode(self, keys: list[str]) -> tuple[Lists, Lists]:
        """The ids on both sides of each unit, given without its first blank; none if they do not spell the unit."""
        found: list[tuple[Lists, Lists]] = []
        for some in _runs(keys):
            texts_ = [" " + " ".join(own) for own in some]
            ids_a = [e.ids for e in self.a.encode_batch(texts_, add_special_tokens=False)]
            ids_b = self.b.encode([t[1:] for t in texts_], num_threads=1)
            for own, text, a, b in zip(some, texts_, ids_a, ids_b, strict=True):
                found.append(self._cut(own, text.encode(), a, b if text != " " else [self.lone]))
        return tuple((_flat([x[k][0] for x in found]), _flat([x[k][1] for x in found])) for k in (0, 1))

    def _cut(self, keys: list[str], whole: bytes, ids_a: list[int], ids_b: list[int]) -> tuple[Lists, Lists]:
        """The ids of several units that were encoded as one text."""
        spelled = (b"".join(map(t.__getitem__, i)) for t, i in ((self.bytes_a, ids_a), (self.bytes_b, ids_b)))
        if any(s != whole for s in spelled):
            if len(keys) > 1:
                one_by_one = [self.encode([k]) for k in keys]
                return tuple((_flat([x[k][0] for x in one_by_one]), _flat([x[k][1] for x in one_by_one])) for k in (0, 1))
            nothing = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
            return nothing, nothing
        ends = np.cumsum([len(k.encode()) + 1 for k in keys])
        sides = []
        for ids, sizes in ((ids_a, self.sizes_a), (ids_b, self.sizes_b)):
            values = np.array(ids, dtype=np.int64)
            sides.append((values, np.diff(np.searchsorted(np.cumsum(sizes[values]), ends, side="right"), prepend=0)))
        return sides[0], sides[1]


def _flat(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)


def _runs(keys: list[str]) -> Iterator[list[list[str]]]:
    """The units in order as runs that can be encoded as one text: only the last of a run may end in white space."""
    runs: list[list[str]] = []
    filled = RUN_CHARS
    for key in keys:
        if filled >= RUN_CHARS:
            runs.append([])
            filled = 0
        runs[-1].append(key)
        filled += len(key) + 1
        if not key or _ends_white(key):
            filled = RUN_CHARS
    for at in range(0, len(runs), 64):
        yield runs[at : at + 64]


@lru_cache(maxsize=1)
def load(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


class Ragged:
    """Lists of ids one after the other in one array."""

    def __init__(self) -> None:
        self.values, self.ends = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values = np.concatenate([self.values, values])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the lists with these numbers, and the size of each list."""
        starts, sizes = self.ends[numbers], self.ends[numbers + 1] - self.ends[numbers]
        skipped = np.repeat(starts - np.append(0, np.cumsum(sizes)[:-1]), sizes)
        return self.values[np.arange(len(skipped)) + skipped], sizes


class Units:
    """Numbers of the units that a task has met, and their ids on both sides."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.a, self.b = Ragged(), Ragged()

    def numbers(self, keys: list[str]) -> np.ndarray:
        if len(self.a.values) + len(self.b.values) > MEMO_TOKENS:
            self.clear()
        new = [k for k in dict.fromkeys(keys) if k not in self.known]
        if new:
            for side, lists in zip((self.a, self.b), self.pair.encode(new), strict=True):
                side.extend(*lists)
            first = len(self.known)
            self.known.update(zip(new, range(first, first + len(new)), strict=True))
        return np.fromiter(map(self.known.__getitem__, keys), dtype=np.int64, count=len(keys))


def unit_keys(text: str) -> list[str]:
    """The units of a blank and the text, each without its first blank."""
    whole = " " + text
    if _blank_beside_white(whole):
        return [u[1:] for u in _unit_borders(whole)]
    return whole.split(" ")[1:]


# ---- texts --------------------------------------------------------------------------------------------------


@dataclass
class Aligned:
    """What is known of one text so far."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    shown: list[str] | None = None


def _parts(batch: list[str | None]) -> Iterator[tuple[list[str], list[int], list[int]]]:
    """Units of the texts up to about ``PART_BYTES`` at a time, with the numbers of the texts and how many each has."""
    keys: list[str] = []
    owners: list[int] = []
    counts: list[int] = []
    filled = 0
    for n, text in enumerate(batch):
        if not text or BLANK in text:
            continue
        own = unit_keys(text)
        step = max(1, len(own) * PART_BYTES // max(len(text), 1))
        for at in range(0, len(own), step):
            some = own[at : at + step]
            keys += some
            owners.append(n)
            counts.append(len(some))
            filled += len(text) * len(some) // len(own)
            if filled >= PART_BYTES:
                yield keys, owners, counts
                keys, owners, counts, filled = [], [], [], 0
    if keys:
        yield keys, owners, counts


def _shown(pair: Pair, ids_a: np.ndarray, ids_b: np.ndarray, merged: Merged) -> np.ndarray:
    """The tokens of both sides in the order in which the groups are written: places in the two tables of ``Pair``."""
    last_a = np.append(merged.group_of_a[1:] != merged.group_of_a[:-1], True)
    last_b = np.append(merged.group_of_b[1:] != merged.group_of_b[:-1], True)
    through_a, through_b = np.cumsum(np.bincount(merged.group_of_a)), np.cumsum(np.bincount(merged.group_of_b))
    out = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    before = np.append(0, through_b)[merged.group_of_a]
    out[np.arange(len(ids_a)) + before] = 2 * ids_a + last_a
    out[np.arange(len(ids_b)) + through_a[merged.group_of_b]] = len(pair.shown_a) + 2 * ids_b + last_b
    return out


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.pair = load(path_a, path_b)
        self.units = Units(self.pair)
        self.table = self.pair.shown_a + self.pair.shown_b

    def align(self, batch: list[str | None]) -> dict[str, pa.Array]:
        found = [Aligned() for _ in batch]
        spoilt: set[int] = set()
        keys, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        pairs = len(self.pair.sizes_a) * len(self.pair.sizes_b)
        for units, owners, sizes in _parts(batch):
            numbers = self.units.numbers(units)
            (ids_a, sizes_a), (ids_b, sizes_b) = self.units.a.take(numbers), self.units.b.take(numbers)
            owner = np.repeat(np.array(owners), sizes)
            spoilt.update(np.unique(owner[sizes_a == 0]).tolist())
            if not len(ids_a):
                continue
            merged = merge(np.cumsum(self.pair.sizes_a[ids_a]), np.cumsum(self.pair.sizes_b[ids_b]))
            of_link = np.repeat(owner, sizes_a)[merged.left]
            shown = _shown(self.pair, ids_a, ids_b, merged)
            spans = np.append(0, np.cumsum(sizes))
            until_a, until_b = np.append(0, np.cumsum(sizes_a))[spans], np.append(0, np.cumsum(sizes_b))[spans]
            links = np.bincount(of_link, minlength=len(batch))
            seen = set()
            for k, n in enumerate(owners):
                own, a0, a1, b0, b1 = found[n], until_a[k], until_a[k + 1], until_b[k], until_b[k + 1]
                if a0 == a1:
                    continue
                own.n_a, own.n_b = own.n_a + int(a1 - a0), own.n_b + int(b1 - b0)
                own.n_groups += int(merged.group_of_a[a1 - 1] - merged.group_of_a[a0]) + 1
                own.n_links += 0 if n in seen else int(links[n])
                seen.add(n)
                text = "".join(map(self.table.__getitem__, shown[a0 + b0 : a1 + b1].tolist()))
                own.shown = [*(own.shown or []), text]
            key = of_link * pairs + ids_a[merged.left] * len(self.pair.sizes_b) + ids_b[merged.right]
            some, times = np.unique(key, return_counts=True)
            keys.append(some)
            counts.append(times)
        return self._columns(found, spoilt, np.concatenate(keys), np.concatenate(counts), pairs)

    def _columns(
        self, found: list[Aligned], spoilt: set[int], keys: np.ndarray, counts: np.ndarray, pairs: int
    ) -> dict[str, pa.Array]:
        for n in spoilt:
            found[n] = Aligned()
        kept = ~np.isin(keys // pairs, list(spoilt))
        distinct, place = np.unique(keys[kept], return_inverse=True)
        times = np.bincount(place, weights=counts[kept]).astype(np.int32) if len(place) else np.zeros(0, dtype=np.int32)
        a, b = np.divmod(distinct % pairs, len(self.pair.sizes_b))
        values = [pa.array(x, pa.int32()) for x in (a.astype(np.int32), b.astype(np.int32), times)]
        struct = pa.StructArray.from_arrays(values, fields=[pa.field(n, pa.int32(), False) for n in "abn"])
        offsets = np.searchsorted(distinct, np.arange(len(found) + 1) * pairs).astype(np.int32)
        numbers = {n: pa.array([getattr(x, n) for x in found], pa.int64()) for n in NUMBERS}
        shown = pa.array([None if x.shown is None else "".join(x.shown)[:-1] for x in found], pa.string())
        return {**numbers, "groups": shown, "links": pa.ListArray.from_arrays(offsets, struct)}


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """``df`` without the text, with the number of tokens on both sides, of groups and of links, the ``groups`` as text
    (``a1,a2|b1;a3|b2,b3``) and the distinct ``links`` (ids ``a`` and ``b``, and how often).

    ``path_a`` names a byte-level BPE file of the ``tokenizers`` library, ``path_b`` a ``sentencepiece`` model that adds a
    blank in front of a text, on every worker.
    """
    rows = df.select(*replacing(df.drop(text), *NUMBERS, "groups", "links"), F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([*rows.drop("__text").schema, *(T.StructField(n, T.LongType(), False) for n in NUMBERS)])
    schema = schema.add("groups", "string").add("links", LINKS, False)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            yield with_columns(batch.drop_columns(["__text"]), **aligner.align(texts(batch, "__text")))

    return rows.mapInArrow(work, schema)


def count_pairs(aligned: DataFrame) -> DataFrame:
    """Each pair of ids that is linked anywhere: in how many rows (``held``), and whether no pair of the same ``a`` is in
    more (``best``). A pair counts once in a task for all of its rows before it travels."""
    pairs = aligned.select(F.inline("links")).select(_pair().alias("pair"))
    counted = pairs.groupBy("pair").agg(F.count("*").alias("held"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))  # at most as many rows as side B has ids
    return counted.withColumn("best", F.col("held") == F.max("held").over(of_a))


def _pair() -> Column:
    return F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")


def score_links(aligned: DataFrame, row: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned``, which must be stored and have a unique ``row``, without the links, with ``n_best`` (links whose pair is
    the best of its ``a``) and ``count_sum`` (how many rows hold the pair, summed over the links)."""
    counted = stage(count_pairs(aligned), "pairs")
    if counted.limit(broadcast_pairs + 1).count() <= broadcast_pairs:
        counted = F.broadcast(counted)
    links = aligned.select(F.col(row).alias("__row"), F.inline("links")).select("__row", _pair().alias("pair"), "n")
    times = F.col("n").cast("long")
    sums = links.join(counted, "pair").groupBy("__row").agg(
        F.sum(F.when(F.col("best"), times).otherwise(0)).alias("__best"), F.sum(times * F.col("held")).alias("__sum")
    )
    out = aligned.drop("links").join(sums, F.col(row) == F.col("__row"), "left")
    zero = F.lit(0).cast("long")
    kept = replacing(aligned.drop("links"), "n_best", "count_sum")
    return out.select(*kept, F.coalesce("__best", zero).alias("n_best"), F.coalesce("__sum", zero).alias("count_sum"))
