"""Anti-joins and the surrogate-key lookup."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.operators.setops import union_all
from tallystar.operators.skew import salted_join

# A date dimension of 500 years stays below this; its key and date take about 10 MB.
BROADCAST_ROWS = 200_000


def anti_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, skewed_left: bool = False
) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``.

    The right side is reduced to its distinct keys first, so a key with very many rows there shrinks inside the map
    tasks, and the exchange of the distinct keys is the one that the join needs. For a left side that is known to be
    skewed, ``skewed_left`` also compares a hash: both sides then have an exchange of their own, which adaptive
    execution needs to split a key, or a missing one, with very many rows on the left.
    """
    return _match(left, right, left_key, right_key, "left_anti", skewed_left)


def semi_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, skewed_left: bool = False
) -> DataFrame:
    """Rows of ``left`` with a partner in ``right``, joined in the same way."""
    return _match(left, right, left_key, right_key, "left_semi", skewed_left)


def _match(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str, skewed_left: bool
) -> DataFrame:
    present = right.select(F.col(right_key).alias("_present")).distinct()
    same = left[left_key] == F.col("_present")
    if skewed_left:
        same = (F.xxhash64(left[left_key]) == F.xxhash64("_present")) & same
    return left.join(present, same, how)


def anti_join_sql(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """The same as a correlated NOT EXISTS in SQL."""
    return left.sparkSession.sql(
        f"""
        SELECT l.* FROM {{left}} l
        WHERE NOT EXISTS (
            SELECT 1 FROM (SELECT DISTINCT {right_key} FROM {{right}}) r
            WHERE r.{right_key} = l.{left_key}
        )
        """,
        left=left,
        right=right,
    )


def lookup(fact: DataFrame, dimension: DataFrame, on: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join of a fact to a dimension; facts without a key in the dimension are dropped.

    The dimension must be a stored table, so that counting it is a read of file footers. Up to ``max_rows`` it
    is broadcast and the fact is not shuffled at all; a larger one is joined by a shuffle in which hot keys of
    the fact are salted.
    """
    if dimension.limit(max_rows + 1).count() <= max_rows:
        return fact.join(F.broadcast(dimension), on)
    return salted_join(fact, dimension, on)


def missing_members(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Identifiers that a fact refers to and that are not in their dimension: ``dimension``, ``member`` (bigint) and
    ``n_rows``, the rows of the fact that refer to it. References that are NULL refer to nothing.

    ``dimensions`` maps a column of the fact to the one-column table of its identifiers. The fact is read once whatever
    the number of dimensions: each row gives one reference per dimension, and equal references are counted in the map
    tasks, so a hot identifier travels as one row per task. What is known of all dimensions is one anti-join.
    """
    references = F.array(
        *(F.struct(F.lit(c).alias("dimension"), F.col(c).cast("bigint").alias("member")) for c in dimensions)
    )
    counted = fact.select(F.inline(references)).where("member IS NOT NULL").groupBy("dimension", "member")
    counted = counted.agg(F.count(F.lit(1)).alias("n_rows"))
    known = [
        ids.select(F.lit(c).alias("_dimension"), F.col(ids.columns[0]).cast("bigint").alias("_member"))
        for c, ids in dimensions.items()
    ]
    held = union_all(*known)
    same = (F.col("dimension") == F.col("_dimension")) & (F.col("member") == F.col("_member"))
    return counted.join(held, same, "left_anti")
