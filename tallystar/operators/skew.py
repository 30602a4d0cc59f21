"""Joins in which one key may hold a large share of the rows.

A key is hot if it holds more than 1/parts of all rows, so there are fewer than ``parts`` hot keys whatever the
data is, and that list is small enough to broadcast. Each hot key is spread over as many salts as it has such
shares; only its partner rows are repeated, once per salt.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.scratch import stage

SALT = "_salt"
_SALTS = "_salts"


@dataclass(frozen=True)
class Salted:
    """Both sides of a join on ``key`` and the salt column."""

    many: DataFrame
    one: DataFrame
    on: tuple[str, str]


def hot_keys(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Fewer than ``parts`` rows: every key above its share, with the number of salts it gets."""
    share = max(df.count() // parts, 1)
    rows = F.count(F.lit(1))
    tally = df.where(F.col(key).isNotNull()).groupBy(key).agg(rows.alias("_rows"))
    hot = tally.where(F.col("_rows") > share)
    return stage(hot.select(key, F.ceil(F.col("_rows") / share).cast("int").alias(_SALTS)), "hot-keys")


def salt_pair(many: DataFrame, one: DataFrame, key: str, parts: int = 200) -> Salted:
    """Add matching salts: one per row on the ``many`` side, all of them on the ``one`` side.

    The salt comes from the row's content and the partition it is read in, not from a random number, so a task
    that runs again gives every row the same salt, and copies of one row still spread out.
    """
    hot = F.broadcast(hot_keys(many, key, parts))
    spread = F.xxhash64(*(F.col(c) for c in many.columns)) + F.spark_partition_id()
    salted = many.withColumn(SALT, spread).join(hot, key, "left")
    salted = salted.withColumn(SALT, F.pmod(SALT, F.coalesce(_SALTS, F.lit(1))).cast("int")).drop(_SALTS)
    repeated = one.join(hot, key, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1))
    )
    return Salted(salted, repeated.drop(_SALTS), (key, SALT))


def salted_join(many: DataFrame, one: DataFrame, key: str, parts: int = 200) -> DataFrame:
    pair = salt_pair(many, one, key, parts)
    return pair.many.join(pair.one, list(pair.on)).drop(SALT)
