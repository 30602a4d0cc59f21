"""Importance resampling towards a target: array-scored weights, then a threshold by numeric bisection.

The features of a text are its runs of one to ``RUN`` words, each hashed to one of ``BUCKETS`` buckets. One pass over the
texts and one over the target count the buckets; a task adds up its own array, so at most ``BUCKETS`` rows a task travel. The
gain of a bucket is the logarithm of how much more frequent it is in the target, in thousandths. A second pass takes a
text's buckets out of the array of gains: their sum is the weight, and the weight with Gumbel noise drawn from the id is
the score, so that the rows with the highest scores are a sample without replacement.

Scores are stored, and exact counts over them, ``SECTIONS`` thresholds a job, close in on the score from which on rows are
drawn; rows that tie there are divided by the same search over their ids, and rows that share an id too by their row
number. Only counts come to the driver. The drawn rows alone are range-partitioned by score and id; the sizes of the
partitions give the ranks.

Defined results: a text that is null, empty or without a word has no features and weight 0, and is not eligible. A null
id takes the noise of an empty one and comes after all others of its score. Rows with equal ids are scored one by one;
rows equal in score and id are drawn in the order of their numbers. A text of any length is worked on in parts of about
``PART_BYTES``. An empty table gives no rows, an empty target gains of its smoothing alone. Input columns of the names that
are added give way to them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.llm.common import replacing, with_columns
from tallystar.scratch import stage

BUCKETS = 10_000
RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
SECTIONS = 16
PART_BYTES = 1 << 20
# What words consist of and what stands between them, in the bytes of a text with A-Z in lower case.
_words = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
_gap = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]").search
_LAST_ID = (1 << 63) - 1


def word_parts(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, with A-Z in lower case, some at a time."""
    text, at = text.lower(), 0
    while at < len(text):
        gap = _gap(text, at + PART_BYTES)
        end = gap.start() if gap else len(text)
        yield _words(text, at, end)
        at = end


def runs_of(text: bytes, buckets: int) -> Iterator[list[np.ndarray]]:
    """For each part of a text the buckets of the runs that end in it, by the number of their words."""
    held: list[int] = []  # the hashes of the last word, the last two words, ... before this part
    for words in word_parts(text):
        if not words:
            continue
        spaced = [b" " + w for w in words]
        ends = [list(map(crc32, words))]
        for k in range(RUN - 1):  # a run's hash goes on from that of the run without its last word
            before = held[k : k + 1] + ends[k][:-1]
            ends.append(list(map(crc32, spaced[len(spaced) - len(before) :], before)))
        held = [e[-1] for e in ends if e]
        yield [np.array(e, dtype=np.int64) % buckets for e in ends]


def _binary(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return (value.as_py() or b"" for value in column)


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How often the features of all texts fall into each bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for value in _binary(batch, "text"):
                for ends in runs_of(value, buckets):
                    total += np.bincount(np.concatenate(ends), minlength=buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(filled, pa.int64()), "n": pa.array(total[filled])})

    rows = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(work, "bucket long, n long")
    found = np.zeros(buckets, dtype=np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():  # at most ``buckets`` rows
        found[bucket] = n
    return found


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much more frequent each bucket is in the target, smoothed by one."""
    size = len(source)
    all_source, all_target = float(source.sum() + size), float(target.sum() + size)
    counts = zip(source.tolist(), target.tolist(), strict=True)
    ratios = ((t + 1.0) * all_source / ((s + 1.0) * all_target) for s, t in counts)
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def weighted(df: DataFrame, gains: np.ndarray, text: str = "text") -> DataFrame:
    """``df`` without the text, with ``n_words``, ``n_features`` and ``weight``, the sum of the features' gains."""
    added = ("n_words", "n_features", "weight")
    rows = df.select(*replacing(df.drop(text), *added), F.col(f"`{text}`").alias("__text"))
    kept = rows.drop("__text").schema
    schema = T.StructType([*kept, *(T.StructField(n, T.LongType(), False) for n in added)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.zeros((3, batch.num_rows), dtype=np.int64)
            for i, value in enumerate(_binary(batch, "__text")):
                for ends in runs_of(value, len(gains)):
                    found = np.concatenate(ends)
                    sums[:, i] += len(ends[0]), len(found), gains[found].sum()
            new = {name: pa.array(values) for name, values in zip(added, sums, strict=True)}
            yield with_columns(batch.drop_columns(["__text"]), **new)

    return rows.mapInArrow(work, schema)


def noise(row_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the digest of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((drawn + 0.5) / F.lit(float(1 << 32))))).cast("long")


def least_reaching(rows: DataFrame, column: str, wanted: int) -> tuple[int, int]:
    """The least value that ``wanted`` rows do not exceed, by bisection with exact counts, and how many are below it."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    below = 0
    while low < high:
        width = high - low
        marks = sorted({low + width * i // SECTIONS for i in range(SECTIONS)})
        counts = rows.agg(*(F.count_if(F.col(column) <= m) for m in marks)).first()
        reached = next((i for i, n in enumerate(counts) if n >= wanted), len(marks))
        if reached > 0:
            low, below = marks[reached - 1] + 1, counts[reached - 1]
        if reached < len(marks):
            high = marks[reached]
    return low, below


def drawn_rows(rows: DataFrame, keys: list[str], wanted: int) -> Column:
    """Whether a row is one of the first ``wanted`` in the order of the integer ``keys``, of which the last is unique."""
    drawn, tied = F.lit(False), F.lit(True)
    for key in keys:
        if not wanted:
            return drawn
        cut, below = least_reaching(rows.where(tied), key, wanted)
        drawn, tied = drawn | (tied & (F.col(key) < cut)), tied & (F.col(key) == cut)
        wanted -= below
    return drawn | tied if wanted else drawn


def with_ranks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with their place in the order of ``keys``, from 1: range partitions with their sizes as offsets."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # The number holds the partition above 33 bits, and the place of the row in it.
    placed = stage(ordered.withColumn("__place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__place", 33)
    sizes = sorted(placed.groupBy(part).count().collect())  # one row per partition
    ends = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    offsets = [(p, end) for (p, _), end in zip(sizes, ends, strict=False)]
    offsets = spark.createDataFrame(offsets, "__part long, __offset long")
    found = placed.join(F.broadcast(offsets), part == F.col("__part"))
    rank = F.col("__offset") + F.col("__place").bitwiseAND((1 << 33) - 1) + 1
    return found.select(*rows.columns, rank.alias("rank"))


def resample(
    df: DataFrame,
    target: DataFrame,
    text: str = "text",
    row_id: str = "doc_id",
    target_text: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``df`` without the text, with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (all long).

    Of the rows with at least ``min_words`` words, ``percent`` in a hundred (rounded down) have a rank, from 1 for the
    highest score; equal scores go by the integer ``row_id``.
    """
    gains = bucket_gains(bucket_counts(df, text, buckets), bucket_counts(target, target_text, buckets))
    own = df.select(*replacing(df, "score", "rank"))
    scored = weighted(own, gains, text).withColumn("score", F.col("weight") + noise(F.col(f"`{row_id}`"), seed))
    keys = {
        "__down": -F.col("score"),
        "__id": F.coalesce(F.col(f"`{row_id}`").cast("long"), F.lit(_LAST_ID)),
        "__row": F.monotonically_increasing_id(),
    }
    scored = stage(scored.withColumns(keys), "scored")
    eligible = F.col("n_words") >= min_words
    wanted = scored.where(eligible).count() * percent // 100
    drawn = eligible & drawn_rows(scored.where(eligible).select(*keys), list(keys), wanted)
    ranks = with_ranks(scored.where(drawn), list(keys))
    rest = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranks.unionByName(rest).drop(*keys)
