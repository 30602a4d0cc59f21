"""BPE encoding and decoding with a pair occurrence index.

The distinct new chunks of a batch lie side by side in one linked list of symbols, held as arrays. An index maps the
rank of each pair of neighbours to all its places in the list; a heap holds the ranks that are active. The lowest rank
is taken, merged at all its places from left to right, and the place lists of the pairs that this creates are updated,
until no rank is active.

Defined results: a null or empty text has no ids and decodes to the empty text. Special strings are one id each.
Rows are encoded one by one; input columns of the names that are added give way to them. A text of any length is encoded
whole, in a batch of its own if it is large. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.llm.common import gathered, parted, replacing, texts, with_columns
from tallystar.llm.vocabulary import Memo, RankTable, chunk_keys, load, pre_tokens

GAP = -1  # stands between sequences and where a symbol was taken; in no pair


def _sorted(places: list[np.ndarray]) -> np.ndarray:
    """The distinct places of all lists, in order."""
    out = np.concatenate(places)
    out.sort()
    return out[np.append(True, out[1:] != out[:-1])]


class PairIndex:
    """Places of each active rank in one linked list of symbols."""

    def __init__(self, symbols: np.ndarray, table: RankTable):
        self.symbols, self.table = symbols, table
        self.before = np.arange(-1, len(symbols) - 1)
        self.after = np.arange(1, len(symbols) + 1)
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self.note(np.arange(len(symbols) - 1))

    def note(self, at: np.ndarray) -> None:
        """The pairs that start at these places are new."""
        ranks, _ = self.table.find(self.symbols[at], self.symbols[self.after[at]])
        merging = ranks != self.table.NONE
        ranks, at = ranks[merging], at[merging]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, at = ranks[order], at[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for rank, start, end in zip(ranks[starts].tolist(), starts, [*starts[1:], len(at)], strict=True):
            if rank in self.places:
                self.places[rank].append(at[start:end])
            else:
                self.places[rank] = [at[start:end]]
                heapq.heappush(self.active, rank)

    def merge(self) -> None:
        """Applies the active ranks in ascending order until there are none."""
        symbols, before, after = self.symbols, self.before, self.after
        while self.active:
            rank = heapq.heappop(self.active)
            left, right, merged = self.table.of_rank[rank]
            lists = self.places.pop(rank)
            at = _sorted(lists) if len(lists) > 1 else lists[0]
            at = at[(symbols[at] == left) & (symbols[after[at]] == right)]  # others took part in a merge since
            if left == right and len(at) > 1:  # in a run of places that overlap, every other one merges
                first = np.append(True, after[at[:-1]] != at[1:])
                run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            if not len(at):
                continue
            taken = after[at]
            symbols[at], symbols[taken] = merged, GAP
            after[at] = after[taken]
            before[after[at]] = at
            self.note(_sorted([before[at], at]))


def merge_all(joined: bytes, sizes: np.ndarray, byte_ids: np.ndarray, table: RankTable) -> list[bytes]:
    """The ids of sequences of bytes that stand one after the other, as the bytes of 32-bit numbers."""
    symbols = np.full(len(joined) + len(sizes) + 1, GAP, dtype=np.int64)
    borders = np.append(0, np.cumsum(sizes + 1))
    filled = np.ones(len(symbols), dtype=bool)
    filled[borders] = False
    symbols[filled] = byte_ids[np.frombuffer(joined, dtype=np.uint8)]
    PairIndex(symbols, table).merge()
    left = symbols != GAP
    ends = (4 * np.append(0, np.cumsum(left))[borders]).tolist()
    ids = symbols[left].astype(np.int32).tobytes()
    return [ids[start:end] for start, end in zip(ends, ends[1:], strict=False)]


class Encoder:
    def __init__(self, path: str):
        self.vocabulary = load(path)
        self.table = RankTable(self.vocabulary)
        self.byte_ids = np.array(self.vocabulary.byte_ids, dtype=np.int64)
        self.memo = Memo(self._solve)
        self.special = {s: np.int32(i).tobytes() for s, i in self.vocabulary.special.items()}

    def _solve(self, new: list[str]) -> dict[str, bytes]:
        words = [c for c in new if c.isalpha()]  # one pre-token with the blank before it: no need to look at them one by one
        cut = {c: pre_tokens(c) for c in new if not c.isalpha()}
        pieces = list(set[str]().union(*cut.values()))
        spelled = [p.encode() for p in pieces]
        joined = "".join(f" {w}" for w in words).encode()
        starts = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == ord(" "))
        sizes = [np.diff(starts, append=len(joined)), np.array([len(p) for p in spelled], dtype=np.int64)]
        ids = merge_all(joined + b"".join(spelled), np.concatenate(sizes), self.byte_ids, self.table)
        found = dict(zip(words, ids, strict=False))
        known = dict(zip(pieces, ids[len(words) :], strict=True))
        found.update((c, b"".join(map(known.__getitem__, own))) for c, own in cut.items())
        return found

    def encode(self, batch: list[str | None]) -> pa.ListArray:
        segments = [self.vocabulary.segments(t) if t else [] for t in batch]
        keys = [[[] if s in self.special else chunk_keys(s) for s in own] for own in segments]
        known = self.memo.learn(k for own in keys for k in own)
        ids = [
            b"".join(self.special.get(s) or b"".join(map(known.__getitem__, k)) for s, k in zip(own, cut, strict=True))
            for own, cut in zip(segments, keys, strict=True)
        ]
        offsets = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(ids), dtype=np.int32))


class Decoder:
    """The bytes of all ids in one array, from which those of a batch are taken at once."""

    def __init__(self, path: str):
        spelled = load(path).spelled
        size = max(spelled) + 1
        self.table = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(size)), dtype=np.uint8)
        # One more than there are ids: unknown ones are looked up there, and are empty.
        self.sizes = np.array([len(spelled.get(i, b"")) for i in range(size)] + [0], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, column: pa.ListArray) -> pa.Array:
        """The text of each row's ids."""
        row_ids = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = pc.fill_null(column.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        ids[(ids < 0) | (ids >= len(self.sizes))] = len(self.sizes) - 1
        sizes = self.sizes[ids]
        ends = np.append(0, np.cumsum(sizes))
        places = np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends[:-1], sizes)
        out = self.table[places]
        rows = ends[np.append(0, np.cumsum(row_ids))]
        first = out[rows[:-1][np.diff(rows) > 0]]
        whole = out.tobytes()
        if not ((first & 0xC0) == 0x80).any() and _is_utf8(whole):  # no character goes over the end of a row
            buffers = [None, pa.py_buffer(rows.astype(np.int32)), pa.py_buffer(whole)]
            return pa.Array.from_buffers(pa.string(), len(row_ids), buffers)
        return pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(rows, rows[1:], strict=False)], pa.string())


def _is_utf8(data: bytes) -> bool:
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def encode(df: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` without the text, with its token ids (array of int).

    ``path`` names a byte-level BPE file of the ``tokenizers`` library on every worker.
    """
    out = df.select(*replacing(df.drop(text), into), F.col(f"`{text}`").alias("__text"))
    kept = out.drop("__text").schema
    schema = T.StructType([*kept, T.StructField(into, T.ArrayType(T.IntegerType(), False), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in gathered(batches, "__text"):
            ids = encoder.encode(texts(batch, "__text"))
            yield from parted(with_columns(batch.drop_columns(["__text"]), **{into: ids}))

    return out.mapInArrow(work, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids; bytes that are not UTF-8 become U+FFFD, ids that are unknown or null nothing."""
    out = df.select(*replacing(df, into))
    schema = T.StructType([*out.schema, T.StructField(into, T.StringType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(path)
        for batch in batches:
            yield with_columns(batch, **{into: decoder.decode(batch.column(batch.schema.get_field_index(ids)))})

    return out.mapInArrow(work, schema)
