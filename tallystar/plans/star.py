"""From landed tables to a star schema: clean dimensions, a date dimension and keyed facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.functions import calendar_columns, date_key
from tallystar.operators import distinct_rows, lookup, union_all


def date_dimension(*date_columns: DataFrame, iso_year: bool = False) -> DataFrame:
    """One row per date that occurs in any of the one-column inputs, with its calendar fields and key.

    Dates are made distinct before the calendar is computed, so only the dates travel. Rows without a date give
    no dimension row: no fact could refer to it.
    """
    days = [df.select(F.col(df.columns[0]).alias("action_date")) for df in date_columns]
    dates = union_all(*days).where(F.col("action_date").isNotNull()).distinct()
    return dates.select(
        date_key("action_date").alias("time_id"), "action_date", *calendar_columns("action_date", iso_year)
    )


def extracted_dimension(df: DataFrame, *columns: str) -> DataFrame:
    return distinct_rows(df, *columns)


def keyed_fact(fact: DataFrame, dates: DataFrame, date_column: str) -> DataFrame:
    """Replace the date of a fact by its key in the stored date dimension, and drop copies."""
    keys = dates.select("time_id", F.col("action_date").alias(date_column))
    return lookup(fact, keys, date_column).drop(date_column).distinct()
