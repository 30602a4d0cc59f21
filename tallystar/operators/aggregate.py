"""Aggregates over chains of joins, collapsed before every exchange.

A chain such as group -> ... -> fact is walked from the fact upwards: the measure is summed per key, joined to
the next table, summed per that table's parent, and so on. Sums and row counts distribute over the copies a
join makes, so this equals aggregating the fully joined rows, but each exchange carries partial sums. A key
that holds a third of the fact becomes one row per map task before it travels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.operators.joins import semi_join
from tallystar.operators.skew import salted_join

_COPIES = "_copies"


@dataclass(frozen=True)
class Link:
    """One step up a join chain: rows found by ``key`` hand their measures to ``parent``.

    Not ``unique`` is a table in which one key may have very many parents; its hot keys are salted.
    """

    table: DataFrame
    key: str
    parent: str
    unique: bool = True


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def conditional_count(condition: Column) -> Column:
    """Rows for which the condition is true; unknown counts as not true."""
    return F.count_if(condition)


def roll_up(measures: DataFrame, links: Sequence[Link], values: Sequence[str]) -> DataFrame:
    """Carry summed ``values`` up a chain of inner joins, one partial aggregate per step."""
    for link in links:
        steps = link.table.select(link.key, link.parent)
        joined = measures.join(steps, link.key) if link.unique else salted_join(steps, measures, link.key)
        measures = joined.groupBy(link.parent).agg(*(F.sum(value).alias(value) for value in values))
    return measures


def count_pairs(pairs: DataFrame, key: str, member: str, alias: str, within: DataFrame | None = None) -> DataFrame:
    """Distinct members per key, with members restricted to those found in ``within``.

    The match is a semi-join, which cannot multiply rows. It comes first: its exchange by member has placed the pairs
    for the distinct as well, so they travel once before they are counted. A member with very many rows is split by
    adaptive execution.
    """
    matched = pairs.select(key, member).where(F.col(member).isNotNull())
    if within is not None:
        matched = semi_join(matched, within, member, member)
    return matched.distinct().groupBy(key).agg(F.count(F.lit(1)).alias(alias))


def _collapsed(groups: DataFrame, columns: Sequence[str]) -> DataFrame:
    return groups.groupBy(*columns).agg(F.count(F.lit(1)).alias(_COPIES))


def _attach(
    groups: DataFrame,
    measures: DataFrame,
    key: str,
    labels: Sequence[str],
    distinct_counts: Sequence[str],
    counts: Sequence[str],
    sums: Sequence[str],
    unique_groups: bool,
    how: str,
) -> DataFrame:
    rows = groups.select(key, *labels)
    rows = rows.withColumn(_COPIES, F.lit(1).cast("bigint")) if unique_groups else _collapsed(rows, [key, *labels])
    joined = rows.join(measures, key, how)
    copies = F.col(_COPIES)
    columns = [F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in distinct_counts]
    columns += [(F.coalesce(F.col(c), F.lit(0).cast("bigint")) * copies).alias(c) for c in counts]
    columns += [(F.col(s) * copies).cast(measures.schema[s].dataType).alias(s) for s in sums]
    return joined.select(key, *labels, *columns)


def keep_groups(
    groups: DataFrame,
    measures: DataFrame,
    key: str,
    labels: Sequence[str] = (),
    distinct_counts: Sequence[str] = (),
    counts: Sequence[str] = (),
    sums: Sequence[str] = (),
    unique_groups: bool = False,
) -> DataFrame:
    """Left outer join of groups to their measures: an empty group counts 0 and sums to NULL.

    ``unique_groups`` says that ``key`` identifies a row of ``groups``, which then need not be collapsed.
    """
    return _attach(groups, measures, key, labels, distinct_counts, counts, sums, unique_groups, "left")


def match_groups(
    groups: DataFrame,
    measures: DataFrame,
    key: str,
    labels: Sequence[str] = (),
    distinct_counts: Sequence[str] = (),
    counts: Sequence[str] = (),
    sums: Sequence[str] = (),
    unique_groups: bool = False,
) -> DataFrame:
    """Inner join of groups to their measures: empty groups are lost. ``unique_groups`` as in ``keep_groups``."""
    return _attach(groups, measures, key, labels, distinct_counts, counts, sums, unique_groups, "inner")
