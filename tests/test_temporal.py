from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallystar.functions import (
    calendar_columns,
    date_key,
    day_before,
    elapsed,
    hour_component,
    iso_date,
    total_hours,
)
from tallystar.plans.star import date_dimension, keyed_fact
from tallystar.scratch import stage


def _span(spark, hours, kind="timestamp_ntz"):
    start = dt.datetime(2024, 3, 9, 12, 0, 0, 900_000)
    return spark.createDataFrame([(start, start + dt.timedelta(hours=hours))], f"a {kind}, b {kind}")


def test_elapsed_is_an_interval(spark):
    assert _span(spark, 1).select(elapsed("a", "b").alias("e")).schema["e"].dataType.typeName() == "daytimeinterval"


def test_hour_component_ignores_days(spark):
    for hours, expected in ((99.5, 3), (23.99, 23), (24, 0), (-5, -5)):
        assert _span(spark, hours).select(hour_component("a", "b")).first()[0] == expected


def test_total_hours_counts_days(spark):
    for kind in ("timestamp_ntz", "timestamp"):
        assert _span(spark, 99.5, kind).select(total_hours("a", "b")).first()[0] == 99.5


def test_total_hours_floors_each_end(spark):
    start = dt.datetime(2024, 1, 1, 0, 0, 0, 900_000)
    end = dt.datetime(2024, 1, 1, 0, 0, 1, 100_000)
    df = spark.createDataFrame([(start, end)], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(total_hours("a", "b") * 3600).first()[0] == 1.0


def test_calendar_at_year_ends(spark):
    days = [(dt.date(2021, 1, 3),), (dt.date(2024, 12, 30),)]
    df = spark.createDataFrame(days, "d date").select(*calendar_columns("d", iso_year=True))
    assert [tuple(r) for r in df.collect()] == [(53, 1, 2021, 1, 2020), (1, 12, 2024, 2, 2025)]


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 2),)], "d date")
    assert tuple(df.select(date_key("d"), iso_date("d"), day_before("d")).first()) == (
        20210102,
        "2021-01-02",
        dt.date(2021, 1, 1),
    )


def test_date_dimension_skips_missing_dates_and_keeps_keys(spark):
    orders = spark.createDataFrame([(dt.date(2021, 1, 2),), (None,), (dt.date(2021, 1, 2),)], "order_date date")
    feed = spark.createDataFrame([(dt.date(2021, 1, 5),)], "date date")
    dates = date_dimension(orders, feed)
    assert dates.columns[:2] == ["time_id", "action_date"]
    assert sorted(r["time_id"] for r in dates.collect()) == [20210102, 20210105]
    again = date_dimension(feed, orders.repartition(7))
    assert sorted(map(tuple, dates.collect())) == sorted(map(tuple, again.collect()))


def test_keyed_fact_drops_undated_rows_and_copies(spark):
    day = dt.date(2021, 1, 2)
    rows = [(1, day), (1, day), (2, None), (3, dt.date(2021, 1, 9))]
    fact = spark.createDataFrame(rows, "order_id int, order_date date")
    dates = stage(date_dimension(fact.where(F.col("order_id") < 3).select("order_date")), "dates")
    assert [tuple(r) for r in keyed_fact(fact, dates, "order_date").collect()] == [(1, 20210102)]
