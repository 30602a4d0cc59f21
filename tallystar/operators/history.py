"""Versions of dimension rows: what changed is found by row hashes, and each version has the dates it is valid between."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystar.operators.joins import BROADCAST_ROWS
from tallystar.operators.skew import salted_join

VALID_FROM = "valid_from"
VALID_TO = "valid_to"  # the first day on which the version is not valid any more; NULL while it is the last one


def row_hash(columns: Sequence[str]) -> Column:
    """A digest of the columns' values in which NULL differs from every text."""
    return F.sha2(F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in sorted(columns)))), 256)


def with_versions(stored: DataFrame, load: DataFrame, key: str, as_of: dt.date) -> DataFrame:
    """All versions of the identifiers that a load for the day ``as_of`` changes; empty if it changes none.

    ``stored`` holds the versions so far, with both dates; ``load`` has one row per identifier. An identifier is changed
    if the version that is valid on the day has another hash than the row of the load, or if there is none. Its versions
    are then built anew from the days on which its values changed, so it makes no difference whether the day is the
    latest, an earlier one, or was loaded before: a row of the same day replaces the one of the earlier load. A late row
    holds until the next change that is recorded.
    """
    attributes = [c for c in load.columns if c != key]
    day = F.lit(as_of)
    hashed = load.select(key, *attributes, row_hash(attributes).alias("_hash"))
    valid = stored.where((F.col(VALID_FROM) <= day) & (F.col(VALID_TO).isNull() | (day < F.col(VALID_TO))))
    valid = valid.select(F.col(key).alias("_held"), row_hash(attributes).alias("_was"))
    same = F.col(key).eqNullSafe(F.col("_held"))
    changed = hashed.join(valid, same & (F.col("_hash") == F.col("_was")), "left_anti")
    events = changed.select(key, *attributes, day.alias(VALID_FROM), F.lit(1).alias("_new"), "_hash")
    touched = changed.select(F.col(key).alias("_held"))
    before = stored.join(touched, same, "left_semi")
    before = before.select(key, *attributes, VALID_FROM, F.lit(0).alias("_new"), row_hash(attributes).alias("_hash"))
    # One event for a day, that of the load if there are two; the days of an identifier are few.
    days = before.unionByName(events).groupBy(key, VALID_FROM)
    days = days.agg(F.max_by(F.struct(*attributes, "_hash"), F.col("_new")).alias("_row"))
    by_day = Window.partitionBy(key).orderBy(VALID_FROM)
    days = days.withColumn("_before", F.lag("_row._hash").over(by_day))
    days = days.where(~F.col("_row._hash").eqNullSafe(F.col("_before")))
    until = F.lead(VALID_FROM).over(by_day).alias(VALID_TO)
    return days.select(key, "_row", VALID_FROM, until).select(
        *(key if c == key else f"_row.{c}" for c in load.columns), VALID_FROM, VALID_TO
    )


def join_as_of(
    facts: DataFrame, versions: DataFrame, key: str, day: str, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Facts with the version of a dimension row that was valid on their day; facts without one are dropped.

    ``versions`` must be a stored table, so that counting it reads file footers. Up to ``max_rows`` it is broadcast;
    beyond, the join on the identifier is a shuffle in which hot identifiers of the facts are salted.
    """
    small = versions.limit(max_rows + 1).count() <= max_rows
    joined = facts.join(F.broadcast(versions), key) if small else salted_join(facts, versions, key)
    inside = (F.col(VALID_FROM) <= F.col(day)) & (F.col(VALID_TO).isNull() | (F.col(day) < F.col(VALID_TO)))
    return joined.where(inside).drop(VALID_FROM, VALID_TO)
