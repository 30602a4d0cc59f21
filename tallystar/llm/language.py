"""Language identification with bit-sliced Bloom filters over letter trigrams.

One filter holds all languages: a row of bits, one per language, for each position. The rows at a trigram's positions
are combined with AND, which returns every language that contains the trigram at once. A text's trigrams are counted
per language (popcounts), each count is corrected for the false positives that the filter of that language is expected
to give, and the largest corrected count decides.

Learning counts the trigrams of all learnt rows; tasks add up before anything is shuffled. A trigram belongs to a
language if it makes up at least ``MIN_SHARE`` of its trigrams, so no language has more than 1 / MIN_SHARE of them and
what the driver collects is bounded whatever the corpus; and if it is not ``MIN_RATIO`` times rarer than in another.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text when nothing was
learnt. Ties, and texts without any known trigram, go to the language with the most trigrams learnt, then the smaller
name. Rows are judged one by one, whole; input columns of the names that are added give way to them. An empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.llm.common import replacing, texts, with_columns
from tallystar.scratch import stage

UNKNOWN = "und"
MIN_SHARE = 1e-5
MIN_RATIO = 0.05
HASHES = 4
ROWS_PER_TRIGRAM = 32
HELD_TRIGRAMS = 1 << 18  # what a task adds up before it passes its counts on


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def trigrams(batch: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All trigrams of the texts as numbers, and the number of each text's trigrams.

    Letters are lower-cased; any run of other characters is one border, which may stand first or last in a trigram.
    """
    parts = [(t or "").lower().encode("utf-32-le", "surrogatepass") for t in batch]
    border = b"\0\0\0\0"
    points = np.frombuffer(border + border.join(parts) + border, dtype=np.uint32)
    ends = np.cumsum([len(p) // 4 + 1 for p in parts])  # place of the border after each text
    owner_of_border = np.zeros(len(points), dtype=bool)
    owner_of_border[ends] = True
    points = np.where(_letters()[points], points, 0).astype(np.int64)
    first = np.append(True, (points[1:] != 0) | (points[:-1] != 0))
    text_of = np.cumsum(owner_of_border) - owner_of_border
    points, text_of = points[first], text_of[first]
    middle = points[1:-1] != 0
    grams = (points[:-2] << 42 | points[1:-1] << 21 | points[2:])[middle]
    return grams, np.bincount(text_of[1:-1][middle], minlength=len(batch))


def learnable(doc_id: Column) -> Column:
    """Rows that may be learnt from: four fifths, by a checksum of the id; a null id is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def count_trigrams(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Columns ``lang``, ``gram``, ``n``: every trigram of every language and how often it occurs."""
    schema = "lang string, gram long, n long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0
        for batch in batches:
            langs, whole = texts(batch, "lang"), texts(batch, "text")
            for name in set(langs):
                grams, n = np.unique(
                    trigrams([t for t, own in zip(whole, langs, strict=True) if own == name])[0], return_counts=True
                )
                held.setdefault(name, []).append((grams, n))
                size += len(grams)
            if size > HELD_TRIGRAMS:
                held = {name: [_added(parts)] for name, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
            if size > HELD_TRIGRAMS:
                yield from _emit(held)
                held, size = {}, 0
        yield from _emit(held)

    rows = df.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return rows.mapInArrow(work, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(place, np.concatenate([n for _, n in parts])).astype(np.int64)


def _emit(held: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
    for name, parts in held.items():
        grams, n = _added(parts)
        names = pa.array([name] * len(grams), pa.string())
        yield pa.RecordBatch.from_pydict({"lang": names, "gram": pa.array(grams), "n": pa.array(n)})


@dataclass(frozen=True)
class Filters:
    languages: list[str]  # the one with the most trigrams first
    rows: np.ndarray  # bits of the languages at each position, 64 to a column
    false_rate: np.ndarray  # of each language

    @staticmethod
    def positions(grams: np.ndarray, rows: int) -> Iterator[np.ndarray]:
        mixed = grams.astype(np.uint64)
        for _ in range(HASHES):
            mixed = (mixed + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(29)
            yield (mixed >> np.uint64(8)) % np.uint64(rows)

    @classmethod
    def build(cls, members: list[tuple[int, list[str]]], languages: list[str]) -> Filters:
        """``members``: each trigram with the languages that contain it."""
        size = max(1024, ROWS_PER_TRIGRAM * len(members))
        rows = np.zeros((size, -(-len(languages) // 64)), dtype=np.uint64)
        number = {name: i for i, name in enumerate(languages)}
        for name in languages:
            grams = np.array([g for g, own in members if name in own], dtype=np.int64)
            column, bit = divmod(number[name], 64)
            for at in cls.positions(grams, size):
                rows[at, column] |= np.uint64(1 << bit)
        filled = [((rows[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))]
        return cls(languages, rows, np.array(filled) ** HASHES)

    def containing(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the languages that contain each trigram."""
        found = np.full((len(grams), self.rows.shape[1]), ~np.uint64(0))
        for at in self.positions(grams, len(self.rows)):
            found &= self.rows[at]
        return found

    def decide(self, batch: list[str | None]) -> tuple[list[str], np.ndarray]:
        grams, n = trigrams(batch)
        if not self.languages:
            return [UNKNOWN] * len(batch), np.zeros(len(batch))
        found = self.containing(grams)
        owner = np.repeat(np.arange(len(batch)), n)
        hits = np.empty((len(batch), len(self.languages)))
        for i in range(len(self.languages)):
            bit = (found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            hits[:, i] = np.bincount(owner, bit, minlength=len(batch))
        total = n[:, None].astype(float)
        corrected = np.clip((hits - total * self.false_rate) / (1 - self.false_rate), 0, total)
        best = corrected.argmax(axis=1)
        score = corrected[np.arange(len(batch)), best] / np.maximum(n, 1)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, n, strict=True)], score


def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> Filters:
    """Filters from the rows of ``df`` that have a text and a language."""
    counts = stage(count_trigrams(df, text, lang), "trigrams")
    counts = counts.join(counts.groupBy("lang").agg(F.sum("n").alias("total")), "lang")
    shares = counts.select("lang", "gram", "total", (F.col("n") / F.col("total")).alias("share"))
    shares = shares.where(F.col("share") >= MIN_SHARE)
    members = shares.groupBy("gram").agg(F.collect_list(F.struct("lang", "share", "total")).alias("own")).collect()
    totals = {o["lang"]: o["total"] for row in members for o in row["own"]}
    kept = []
    for row in members:
        top = max(o["share"] for o in row["own"])
        kept.append((row["gram"], [o["lang"] for o in row["own"] if o["share"] >= MIN_RATIO * top]))
    return Filters.build(sorted(kept), sorted(totals, key=lambda name: (-totals[name], name)))


def identify(df: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, the share of the text's trigrams that this language contains."""
    shared = df.sparkSession.sparkContext.broadcast(filters)  # its size is bounded by MIN_SHARE
    out = df.select(*replacing(df, "lang_pred", "score"))
    added = [T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score = shared.value.decide(texts(batch, text))
            yield with_columns(batch, lang_pred=pa.array(names, pa.string()), score=pa.array(score, pa.float64()))

    return out.mapInArrow(work, T.StructType([*out.schema, *added]))
