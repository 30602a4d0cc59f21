"""Packing into optimal length buckets.

The lengths of all sequences are counted into one histogram. A dynamic programme over it chooses the bucket boundaries
that need the least padding, and inside a bucket sequences are put into batches whose padded size fits a token budget.
Documents longer than ``max_length`` become several sequences, so the histogram has at most ``max_length`` rows, which
is what bounds the work of the driver.

A bucket is numbered in shards of about ``SHARD_ROWS`` sequences that a hash of the row's number chooses, so a bucket with a
third of all rows is many tasks, also where a third of the rows have one id; only the last batch of a shard may be less than full.

Defined results: a null or zero length gives one row with part 0, length 0, bucket length 0 and no batch. Rows with
equal ids are packed one by one, each in the place of its number. An empty table gives no rows. Fewer distinct lengths than buckets give as many buckets as lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallystar.llm.common import replacing, texts, with_columns
from tallystar.llm.vocabulary import PRE_TOKEN, load
from tallystar.scratch import stage

MAX_LENGTH = 2048
BUCKETS = 8
BUDGET = 1 << 14
SHARD_ROWS = 1 << 16


def optimal_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least total padding; the last is the largest length."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), dtype=np.float64)
    counts = np.array([histogram[int(n)] for n in lengths], dtype=np.float64)
    rows = np.append(0, np.cumsum(counts))
    tokens = np.append(0, np.cumsum(counts * lengths))
    size = len(lengths)
    # cost[j]: least padding of the first j lengths with the buckets so far; a bucket of i..j-1 is padded to lengths[j-1].
    cost = np.append(0, lengths * rows[1:] - tokens[1:])
    choices = []
    for _ in range(1, min(buckets, size)):
        better, choice = cost.copy(), np.zeros(size + 1, dtype=np.int64)
        for j in range(1, size + 1):
            total = cost[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            choice[j] = int(total.argmin())
            better[j] = total[choice[j]]
        cost = better
        choices.append(choice)
    bounds, j = [], size
    for choice in reversed(choices):
        if j:
            bounds.append(int(lengths[j - 1]))
            j = int(choice[j])
    if j:
        bounds.append(int(lengths[j - 1]))
    return sorted(bounds)


def words(text: Column) -> Column:
    """The number of words of a text, as a length that needs no vocabulary."""
    whole = F.coalesce(text, F.lit(""))
    return F.size(F.array_remove(F.split(whole, r"[\x20\x09-\x0D]+"), "")).cast("long")


class Lengths:
    """Numbers of tokens by the public library that takes a vocabulary as ranks: it keeps nothing between texts."""

    def __init__(self, path: str):
        import tiktoken

        vocabulary = load.__wrapped__(path)  # not remembered: the library has its own copy
        merged = [m for _, m in sorted(vocabulary.merges.values())]
        if merged != sorted(merged) or merged[0] < max(vocabulary.byte_ids):
            raise ValueError(f"the ids of {path} are not in the order of its merges")
        ranks = {b: i for i, b in vocabulary.spelled.items() if i not in vocabulary.special.values()}
        self.encoding = tiktoken.Encoding(
            "lengths", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens=dict(vocabulary.special)
        )

    def of(self, text: str | None) -> int:
        return len(self.encoding.encode_to_numpy(text, allowed_special="all")) if text else 0


def token_lengths(df: DataFrame, path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """``df`` without the text, with its number of tokens (long); none of a null text."""
    rows = df.select(*replacing(df.drop(text), into), F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([*rows.drop("__text").schema, T.StructField(into, T.LongType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(path)
        for batch in batches:
            counts = pa.array(map(lengths.of, texts(batch, "__text")), pa.int64())
            yield with_columns(batch.drop_columns(["__text"]), **{into: counts})

    return rows.mapInArrow(work, schema)


def pack_tokens(df: DataFrame, path: str, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """``pack`` with lengths in tokens of the byte-level BPE file ``path``."""
    rows = df.select(F.col(f"`{row_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return pack(token_lengths(rows, path).withColumnRenamed("id", row_id), F.col("n_tokens"), row_id)


def pack(
    df: DataFrame,
    length: Column,
    row_id: str = "doc_id",
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """One row per sequence: the id, ``part``, ``start`` and ``length`` in the document, ``bucket_length``,
    ``padding`` and ``batch_id``."""
    if budget < max_length:
        raise ValueError("a batch must hold a sequence of max_length")
    rows = df.select(F.col(f"`{row_id}`").alias("id"), F.coalesce(length, F.lit(0)).cast("long").alias("total"))
    last = F.greatest(F.lit(0), F.ceil(F.col("total") / max_length) - 1)
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part"))
    start = F.col("part") * max_length
    rows = rows.select("id", "part", start.alias("start"), F.least(F.lit(max_length), F.col("total") - start).alias("length"))
    # Shards go by the number of the stored row, so rows without an id or with equal ones spread like all others.
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "sequences")
    counted = rows.where("length > 0").groupBy("length").count().collect()  # at most max_length rows
    histogram = {r["length"]: r["count"] for r in counted}
    bounds = optimal_bounds(histogram, buckets)

    empty = F.col("length") <= 0
    bucket, capacity, shards = F.lit(0).cast("long"), F.lit(1).cast("long"), F.lit(1).cast("long")
    for low, bound in reversed(list(zip([0, *bounds], bounds, strict=False))):
        held = sum(n for size, n in histogram.items() if low < size <= bound)
        inside = F.col("length") <= bound
        bucket = F.when(inside, F.lit(bound).cast("long")).otherwise(bucket)
        capacity = F.when(inside, F.lit(budget // bound).cast("long")).otherwise(capacity)
        shards = F.when(inside, F.lit(-(-held // SHARD_ROWS)).cast("long")).otherwise(shards)
    placed = rows.withColumns(
        {
            "bucket_length": F.when(empty, 0).otherwise(bucket),
            "capacity": capacity,
            "hash": F.xxhash64("row"),
        }
    ).withColumn("shard", F.pmod("hash", shards))
    # Rows without tokens are in no batch and stay out of the numbering.
    order = Window.partitionBy("bucket_length", "shard").orderBy("hash", "row")
    number = F.floor((F.row_number().over(order) - 1) / F.col("capacity"))
    batch = F.concat_ws("-", "bucket_length", "shard", number.cast("long"))
    packed = placed.where(~empty).withColumn("batch_id", batch)
    packed = packed.unionByName(placed.where(empty).withColumn("batch_id", F.lit(None).cast("string")))
    return packed.select(
        F.col("id").alias(row_id),
        "part",
        "start",
        "length",
        "bucket_length",
        (F.col("bucket_length") - F.col("length")).alias("padding"),
        "batch_id",
    )
