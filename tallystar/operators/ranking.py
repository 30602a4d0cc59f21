"""Top-k with explicit NULL order and tie-breaks, and ranks that keep ties."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystar.scratch import stage

# Up to this k, the values that hold the first k ranks are broadcast; for a larger one they are joined by a shuffle.
BROADCAST_RANKS = 100_000


def _order(by: str, descending: bool, nulls_first: bool) -> Column:
    column = F.col(by)
    if descending:
        return column.desc_nulls_first() if nulls_first else column.desc_nulls_last()
    return column.asc_nulls_first() if nulls_first else column.asc_nulls_last()


def sort_by(
    df: DataFrame, by: str, tie_break: Sequence[str], descending: bool = True, nulls_first: bool = False
) -> DataFrame:
    return df.orderBy(_order(by, descending, nulls_first), *tie_break)


def top_k(
    df: DataFrame, by: str, k: int, tie_break: Sequence[str], descending: bool = True, nulls_first: bool = False
) -> DataFrame:
    """The first k rows; planned as a top-k per partition followed by a merge of k rows each."""
    return sort_by(df, by, tie_break, descending, nulls_first).limit(k)


def ranked_with_ties(df: DataFrame, by: str, k: int, descending: bool = True, alias: str = "rnk") -> DataFrame:
    """All rows whose ``rank()`` over the whole result is at most k, with that rank.

    A window without partitions would pull every tied row into one task, and ties are unbounded. A row's rank is
    one plus the number of rows ahead of its value, so the rows are counted per value, the first k values are
    ranked (no more can have a rank up to k), and those at most k values are joined back to the rows. The result
    is not sorted: a sort by rank would gather the ties again.
    """
    head = df.groupBy(F.col(by).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    head = head.orderBy(_order("_value", descending, nulls_first=False)).limit(k)
    ahead = Window.orderBy(_order("_value", descending, nulls_first=False)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    rank = F.coalesce(F.sum("_rows").over(ahead), F.lit(0).cast("bigint")) + 1
    ranks = head.select("_value", rank.alias(alias)).where(F.col(alias) <= k)
    if k <= BROADCAST_RANKS:
        ranks = F.broadcast(ranks)
    return df.join(ranks, df[by].eqNullSafe(ranks["_value"])).drop("_value")


def rank_all(
    df: DataFrame, by: str, descending: bool = True, alias: str = "rnk", parts: int | None = None
) -> DataFrame:
    """All rows with their ``rank()`` over the whole result, without a window over the whole result.

    Rows are counted per value in the map tasks, and the values are put into ``parts`` ranges (the session's shuffle
    partitions unless given). Within a range a running sum counts the rows ahead; the sums of the ranges, one number
    each, give what is ahead of a range. Ties are one value, so no border divides them. The ranks are joined back to the
    rows by value; a value with very many rows is split by adaptive execution.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = _order("_value", descending, nulls_first=False)
    values = df.groupBy(F.col(by).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    ranges = values.repartitionByRange(parts, order).withColumn("_range", F.spark_partition_id())
    ranges = stage(ranges, "ranges")  # the same ranges for the sums and for the rows within
    sums = dict(ranges.groupBy("_range").agg(F.sum("_rows")).collect())
    ahead, offsets = 0, []
    for part in sorted(sums):
        offsets.append((part, ahead))
        ahead += sums[part]
    offsets = F.broadcast(spark.createDataFrame(offsets, "_range int, _offset bigint"))
    within = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(within), F.lit(0).cast("bigint"))
    ranks = ranges.withColumn("_before", before).join(offsets, "_range")
    ranks = ranks.select("_value", (F.col("_offset") + F.col("_before") + 1).alias(alias))
    return df.join(ranks, df[by].eqNullSafe(ranks["_value"])).drop("_value")


@dataclass(frozen=True)
class Arm:
    """One of several top-1 questions asked of the same groups: its measure and its number of input rows."""

    name: str
    value: str
    rows: str


def best_per_arm(totals: DataFrame, key: str, labels: Sequence[str], arms: Sequence[Arm]) -> DataFrame:
    """For each arm the group with the largest measure: columns ``arm``, key, labels and ``value``.

    All arms are answered from one pass over the groups, and so from one scan of the facts below them. A group
    takes part in an arm only if it has rows there; a NULL measure comes last, equal measures go by key.
    """
    rows = F.array(
        *(F.struct(F.lit(a.name).alias("arm"), F.col(a.value).alias("value"), F.col(a.rows).alias("_rows")) for a in arms)
    )
    long = totals.select(key, *labels, F.inline(rows)).where(F.col("_rows") > 0)
    place = F.struct(F.col("value").isNull(), -F.col("value"), F.col(key))
    best = F.min_by(F.struct(key, *labels, "value"), place)
    return long.groupBy("arm").agg(best.alias("best")).select("arm", "best.*")
