"""Token counts by rank-synchronous merging of ragged numpy arrays.

The distinct new chunks of a batch are cut into pre-tokens, whose bytes lie in one array beside the number of the
sequence each belongs to. In every round each sequence applies its own lowest-rank pair at all its places; sequences
without a pair that merges leave the array. What is left of a sequence is its count: no token is ever materialised.

Defined results: a null or empty text has 0 tokens. A special string inside a text counts as one token. Rows are
counted one by one, whatever their ids; input columns of the names that are added give way to them. A text of any length is
counted whole, in a batch of its own if it is large. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.llm.common import gathered, parted, replacing, texts, with_columns
from tallystar.llm.vocabulary import Memo, RankTable, chunk_keys, load, pre_tokens


def merged_lengths(sequences: list[bytes], byte_ids: np.ndarray, table: RankTable) -> np.ndarray:
    """Symbols that are left of each sequence of bytes once no pair merges any more."""
    lengths = np.array([len(s) for s in sequences], dtype=np.int64)
    counts = lengths.copy()
    symbols = byte_ids[np.frombuffer(b"".join(sequences), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(sequences)), lengths)
    while len(symbols) > 1:
        ranks, merged = table.find(symbols[:-1], symbols[1:])
        ranks[owner[:-1] != owner[1:]] = table.NONE
        ranks = np.append(ranks, table.NONE)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(starts, len(owner)))
        lowest = np.repeat(np.minimum.reduceat(ranks, starts), sizes)
        at = np.flatnonzero((ranks == lowest) & (ranks != table.NONE))
        if not len(at):
            break
        # In a run of places that overlap (a, a, a) every other one merges, from the left.
        first = np.append(True, np.diff(at) != 1)
        run_start = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        at = at[(at - run_start) % 2 == 0]
        symbols[at] = merged[at]
        counts -= np.bincount(owner[at], minlength=len(counts))
        keep = lowest != table.NONE
        keep[at + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    return counts


class Counter:
    def __init__(self, path: str):
        self.vocabulary = load(path)
        self.table = RankTable(self.vocabulary)
        self.byte_ids = np.array(self.vocabulary.byte_ids, dtype=np.int64)
        self.memo = Memo(self._solve)

    def _solve(self, new: list[str]) -> dict[str, int]:
        cut = [pre_tokens(c) for c in new]
        distinct = list({p for pieces in cut for p in pieces})
        lengths = merged_lengths([p.encode() for p in distinct], self.byte_ids, self.table)
        known = dict(zip(distinct, lengths.tolist(), strict=True))
        return {c: sum(map(known.__getitem__, pieces)) for c, pieces in zip(new, cut, strict=True)}

    def count(self, batch: list[str | None]) -> list[int]:
        special = self.vocabulary.special
        special_counts, keys = [], []
        for text in batch:
            segments = self.vocabulary.segments(text) if text else []
            special_counts.append(sum(s in special for s in segments))
            keys.append([k for s in segments if s not in special for k in chunk_keys(s)])
        known = self.memo.learn(keys)
        return [n + sum(map(known.__getitem__, own)) for n, own in zip(special_counts, keys, strict=True)]


def count_tokens(df: DataFrame, path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """``df`` without the text, with ``n_bytes`` (UTF-8) and the number of tokens (both long).

    ``path`` names a byte-level BPE file of the ``tokenizers`` library on every worker.
    """
    out = df.select(
        *replacing(df.drop(text), "n_bytes", into),
        F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(f"`{text}`").alias("__text"),
    )
    schema = T.StructType([*out.drop("__text").schema, T.StructField(into, T.LongType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in gathered(batches, "__text"):
            counts = pa.array(counter.count(texts(batch, "__text")), pa.int64())
            yield from parted(with_columns(batch.drop_columns(["__text"]), **{into: counts}))

    return out.mapInArrow(work, schema)
