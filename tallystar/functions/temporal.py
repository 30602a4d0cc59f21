"""Column expressions on dates and timestamps. All of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def elapsed(start: ColumnLike, end: ColumnLike) -> Column:
    """``end - start`` as a day-time interval."""
    return _column(end) - _column(start)


def hour_component(start: ColumnLike, end: ColumnLike) -> Column:
    """The hour field of the elapsed interval: 4 days and 3.5 hours give 3."""
    return F.date_part(F.lit("hour"), elapsed(start, end))


def epoch_seconds(at: ColumnLike) -> Column:
    """Whole seconds since 1970, rounded down. A timestamp without zone is taken in the session's zone."""
    return F.unix_seconds(_column(at).cast("timestamp"))


def total_hours(start: ColumnLike, end: ColumnLike) -> Column:
    """Elapsed time in fractional hours; each end is first rounded down to a second."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(3600)


def date_key(day: ColumnLike) -> Column:
    """``yyyyMMdd`` as a 64-bit integer: the same date has the same key in every run."""
    day = _column(day)
    return F.year(day).cast("bigint") * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar_columns(day: ColumnLike, iso_year: bool = False) -> list[Column]:
    """Week is the ISO week, year the calendar year, weekday 1 for Sunday.

    2021-01-03 is week 53 of year 2021 here; ``iso_year`` adds the year that the ISO week belongs to.
    """
    day = _column(day)
    columns = [
        F.weekofyear(day).alias("action_week"),
        F.month(day).alias("action_month"),
        F.year(day).alias("action_year"),
        F.dayofweek(day).alias("action_weekday"),
    ]
    if iso_year:
        columns.append(F.extract(F.lit("YEAROFWEEK"), day).alias("action_iso_year"))
    return columns


def iso_date(day: ColumnLike) -> Column:
    return F.date_format(_column(day), "yyyy-MM-dd")


def day_before(day: ColumnLike) -> Column:
    return F.date_sub(_column(day), 1)
