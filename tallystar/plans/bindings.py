"""The operators bound to the given tables: one query per operator, each over whole tables.

Roles: category -> nation or region, actor -> supplier or customer, rental -> order or order line, payment -> order
line, city -> nation, active customer -> balance not negative, shop orders -> order lines, feed -> events.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.functions import date_key, hour_component, iso_date, total_hours
from tallystar.operators import (
    Arm,
    Link,
    anti_join,
    anti_join_sql,
    best_per_arm,
    conditional_count,
    count_pairs,
    distinct_rows,
    join_as_of,
    keep_groups,
    match_groups,
    missing_members,
    rank_all as rank_every_row,
    ranked_with_ties,
    roll_up,
    salt_pair,
    top_k,
    union_all,
)
from tallystar.operators.ranking import sort_by
from tallystar.operators.skew import SALT
from tallystar.plans import rental
from tallystar.plans.daily import (
    Layout,
    land_database,
    land_feed,
    land_table,
    refine,
    refine_feed,
    refine_table,
    run_daily,
)
from tallystar.plans.star import date_dimension, extracted_dimension, keyed_fact
from tallystar.schemas import SHOP_TABLES
from tallystar.scratch import fresh_dir, stage
from tallystar.session import configure, is_local
from tallystar.sinks import (
    Warehouse,
    append_new_rows,
    append_table,
    bucket_count,
    store_bucketed,
    write_csv,
    write_dated,
    write_parquet,
    write_run_date,
)
from tallystar.sources import (
    Database,
    Evolution,
    Ranges,
    list_tables,
    read_csv,
    read_csv_inferred,
    read_evolved,
    read_feed_dates,
    read_feed_day_before,
    read_json,
    read_json_inferred,
    read_json_merged,
    read_parquet,
    read_run_date,
    read_table,
)
from tallystar.sources.files import run_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

RUN_DATE = dt.date(2024, 1, 3)
FEED_DATES = [dt.date(2024, 1, day) for day in (2, 3, 4, 5)]


def register(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        REGISTRY[name] = lambda spark, sf_dir: query(configure(spark), sf_dir)
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- counts per group ---------------------------------------------------------------------------------------


@register("distinct_count_outer")
def distinct_count_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, supplier, lineitem = (table(spark, sf_dir, n) for n in ("nation", "supplier", "lineitem"))
    rich = supplier.where("s_acctbal > 8000").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    sold = distinct_rows(lineitem, "l_suppkey", "l_partkey").join(rich, "l_suppkey")
    counts = count_pairs(sold, "s_nationkey", "l_partkey", "part_count")
    counts = counts.withColumnRenamed("s_nationkey", "n_nationkey")
    kept = keep_groups(nation, counts, "n_nationkey", ["n_name"], distinct_counts=["part_count"])
    return sort_by(kept, "part_count", ["n_nationkey"])


@register("rowcount_inner")
def rowcount_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, supplier = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    counts = supplier.where("s_acctbal > 8000").groupBy(F.col("s_nationkey").alias("n_nationkey"))
    counts = counts.agg(F.count(F.lit(1)).alias("cnt"))
    matched = match_groups(nation, counts, "n_nationkey", ["n_name"], counts=["cnt"])
    return sort_by(matched.groupBy("n_name").agg(F.sum("cnt").alias("cnt")), "cnt", ["n_name"])


def _orders_per_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), F.col("l_orderkey").alias("o_orderkey")
    )
    orders = table(spark, sf_dir, "orders")
    return count_pairs(lines, "s_suppkey", "o_orderkey", "order_count", within=orders)


@register("topn_distinct")
def topn_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _orders_per_supplier(spark, sf_dir)
    suppliers = keep_groups(
        table(spark, sf_dir, "supplier"), counts, "s_suppkey", ["s_name"], ["order_count"], unique_groups=True
    )
    return top_k(suppliers, "order_count", 10, ["s_suppkey"])


@register("topn_inner")
def topn_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _orders_per_supplier(spark, sf_dir)
    suppliers = match_groups(
        table(spark, sf_dir, "supplier"), counts, "s_suppkey", ["s_name"], ["order_count"], unique_groups=True
    )
    return top_k(suppliers, "order_count", 10, ["s_suppkey"])


@register("conditional_counts")
def conditional_counts(spark: SparkSession, sf_dir: str, sort_column: str = "inactive_count") -> DataFrame:
    values = ["active_count", "inactive_count"]
    balance = F.col("c_acctbal")
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        conditional_count(balance >= 0).alias(values[0]), conditional_count(balance < 0).alias(values[1])
    )
    kept = keep_groups(table(spark, sf_dir, "nation"), counts, "n_nationkey", ["n_name"], counts=values)
    named = kept.groupBy("n_name").agg(*(F.sum(v).alias(v) for v in values))
    return sort_by(named, sort_column, ["n_name"])


# ---- sums per group -----------------------------------------------------------------------------------------


def _spend_per_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders, lineitem = (table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem"))
    spend = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("amt"))
    spend = roll_up(spend, [Link(orders, "o_orderkey", "o_custkey")], ["amt"])
    spend = spend.withColumnRenamed("o_custkey", "c_custkey")
    spend = roll_up(spend, [Link(customer, "c_custkey", "c_nationkey")], ["amt"])
    return spend.withColumnRenamed("c_nationkey", "n_nationkey")


@register("top1_sum")
def top1_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    spend = roll_up(_spend_per_nation(spark, sf_dir), [Link(nation, "n_nationkey", "n_regionkey")], ["amt"])
    spend = spend.withColumnRenamed("n_regionkey", "r_regionkey")
    kept = keep_groups(region, spend, "r_regionkey", ["r_name"], sums=["amt"])
    return top_k(kept, "amt", 1, ["r_regionkey"]).select("r_name", F.round("amt", 2).alias("amt"))


@register("topn_sum_inner")
def topn_sum_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = _spend_per_nation(spark, sf_dir)
    matched = match_groups(table(spark, sf_dir, "nation"), spend, "n_nationkey", sums=["amt"])
    return top_k(matched, "amt", 10, ["n_nationkey"]).select("n_nationkey", F.round("amt", 2).alias("amt"))


@register("top1_sum_nulls_first")
def top1_sum_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    sums = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("qty"))
    kept = keep_groups(table(spark, sf_dir, "orders"), sums, "o_orderkey", sums=["qty"])
    return top_k(kept, "qty", 1, ["o_orderkey"], nulls_first=True)


# ---- anti-joins ---------------------------------------------------------------------------------------------


@register("anti_join")
def anti_join_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anti_join(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey"
    )



@register("anti_join_sql")
def anti_join_sql_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anti_join_sql(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey"
    )



# ---- ranks and top-1 arms -----------------------------------------------------------------------------------


def _economy_lines_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem, part = (table(spark, sf_dir, n) for n in ("orders", "lineitem", "part"))
    economy = part.where(F.col("p_type") == "ECONOMY").select(F.col("p_partkey").alias("l_partkey"))
    lines = lineitem.select("l_orderkey", "l_partkey").join(economy, "l_partkey")
    lines = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("l_partkey").alias("cnt"))
    return roll_up(lines, [Link(orders, "o_orderkey", "o_custkey")], ["cnt"])


@register("rank_ties")
def rank_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranked_with_ties(_economy_lines_per_customer(spark, sf_dir), "cnt", 3)
    return ranked.select("o_custkey", "cnt", "rnk")


@register("rank_ties_asc")
def rank_ties_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranked_with_ties(_economy_lines_per_customer(spark, sf_dir), "cnt", 3, descending=False)
    return ranked.select("o_custkey", "cnt", "rnk")


@register("rank_ties_large")
def rank_ties_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More ranks than are broadcast."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    return ranked_with_ties(lines, "l_extendedprice", 150_000)


@register("rank_all")
def rank_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank of every order line by its price."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rank_every_row(lines, "l_extendedprice")


def _best_regions(
    spark: SparkSession, sf_dir: str, segment: Callable[[Column], Column], priority: Callable[[Column], Column]
) -> DataFrame:
    customer, orders, nation, region = (
        table(spark, sf_dir, n) for n in ("customer", "orders", "nation", "region")
    )
    price, chosen = F.col("o_totalprice"), priority(F.col("o_orderpriority"))
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(price).alias("all_sum"),
        F.count(F.lit(1)).alias("all_rows"),
        F.sum(F.when(chosen, price)).alias("priority_sum"),
        F.count_if(chosen).alias("priority_rows"),
    )
    buyers = customer.select("c_custkey", "c_nationkey", segment(F.col("c_mktsegment")).alias("in_segment"))
    values = ["segment_sum", "segment_rows", "priority_sum", "priority_rows"]
    per_nation = per_customer.join(buyers, "c_custkey").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.sum(F.when(F.col("in_segment"), F.col("all_sum"))).alias(values[0]),
        F.sum(F.when(F.col("in_segment"), F.col("all_rows")).otherwise(0)).alias(values[1]),
        F.sum(values[2]).alias(values[2]),
        F.sum(values[3]).alias(values[3]),
    )
    per_region = roll_up(per_nation, [Link(nation, "n_nationkey", "n_regionkey")], values)
    per_region = per_region.withColumnRenamed("n_regionkey", "r_regionkey")
    totals = match_groups(
        region, per_region, "r_regionkey", ["r_name"], counts=values[1::2], sums=values[0::2]
    )
    arms = [Arm("segment", values[0], values[1]), Arm("priority", values[2], values[3])]
    return best_per_arm(totals, "r_regionkey", ["r_name"], arms).select(F.col("r_name").alias("name"))


@register("union_top1")
def union_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = _best_regions(spark, sf_dir, lambda s: s.ilike("%u%"), lambda p: p.ilike("%-%"))
    return best.distinct()


@register("union_all_top1")
def union_all_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best_regions(spark, sf_dir, lambda s: s.like("%U%"), lambda p: p.like("%-%"))


@register("longest_rented")
def longest_rented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain of seven tables: nation as category and as city, part as its films, order lines as copies of films,
    orders as rentals, customers as customers and as their addresses."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    tables = {
        "category": nation.selectExpr("n_nationkey AS category_id", "n_name AS name"),
        "film_category": table(spark, sf_dir, "part").selectExpr("p_partkey AS film_id", "p_size AS category_id"),
        "inventory": table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS inventory_id", "l_partkey AS film_id"),
        "rental": table(spark, sf_dir, "orders").selectExpr(
            "o_orderkey AS inventory_id",
            "o_custkey AS customer_id",
            "o_orderdate AS rental_date",
            "timestampadd(HOUR, CAST(o_orderkey % 200 AS INT), o_orderdate) AS return_date",
        ),
        "customer": customer.selectExpr("c_custkey AS customer_id", "c_custkey AS address_id"),
        "address": customer.selectExpr("c_custkey AS address_id", "c_nationkey AS city_id"),
        "city": nation.selectExpr(
            "n_nationkey AS city_id",
            "if(n_nationkey % 2 = 0, concat('a', n_name), replace(n_name, '_', '-')) AS city",
        ),
    }
    return rental.longest_rented_category_hours(tables)


@register("like_vs_ilike")
def like_vs_ilike(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").agg(
        conditional_count(segment.like("a%")).alias("n_like"), conditional_count(segment.ilike("a%")).alias("n_ilike")
    )


# ---- elapsed time -------------------------------------------------------------------------------------------


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy("event_type", "user_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))


@register("hour_part")
def hour_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = hour_component("lo", "hi").cast("bigint")
    return _spans(spark, sf_dir).select("event_type", "user_id", hour.alias("h"))


@register("hour_part_sum")
def hour_part_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(spark, sf_dir).groupBy("event_type").agg(F.sum(hour_component("lo", "hi")).alias("h"))


@register("total_hours")
def total_hours_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(spark, sf_dir).select("event_type", "user_id", total_hours("lo", "hi").alias("h"))



@register("total_hours_sum")
def total_hours_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = _spans(spark, sf_dir).groupBy("event_type")
    return spans.agg(F.round(F.sum(total_hours("lo", "hi")), 6).alias("h"))


# ---- star schema --------------------------------------------------------------------------------------------


def _day(column: str, alias: str) -> Column:
    return F.col(column).cast("date").alias(alias)


@register("distinct_rows")
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")



def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return date_dimension(orders.select(_day("o_orderdate", "d")), lineitem.select(_day("l_shipdate", "d")))


@register("date_dim")
def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates(spark, sf_dir)


@register("location_dim")
def location_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return extracted_dimension(customer.select(F.col("c_nationkey").alias("location_area_id")), "location_area_id")


@register("fact_keyed")
def fact_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", _day("o_orderdate", "order_date"))
    return keyed_fact(orders, stage(_dates(spark, sf_dir), "dates"), "order_date")


@register("feed_fact_keyed")
def feed_fact_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"), _day("l_shipdate", "date")
    )
    return keyed_fact(feed, stage(_dates(spark, sf_dir), "dates"), "date")


# ---- files --------------------------------------------------------------------------------------------------


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(F.col("user_id").alias("product_id"), _day("ts", "date"), "event_id")


_FEED_SCHEMA = T.StructType().add("product_id", "long").add("event_id", "long").add("date", "date")


@register("bronze_csv_roundtrip")
def bronze_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = write_run_date(documents, fresh_dir(spark, "documents"), RUN_DATE, "csv")
    return read_csv(spark, path, documents.schema)


@register("bronze_csv_single_column")
def bronze_csv_single_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = table(spark, sf_dir, "lineitem").selectExpr("nullif(l_returnflag, 'A') AS flag")
    path = write_run_date(flags, fresh_dir(spark, "flags"), RUN_DATE, "csv")
    return read_csv(spark, path, flags.schema)


@register("bronze_csv_inferred")
def bronze_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", _day("l_shipdate", "l_shipdate")
    )
    path = f"{fresh_dir(spark, 'lineitem')}/csv"
    write_csv(lines, path)
    return read_csv_inferred(spark, path).withColumn("l_partkey", F.col("l_partkey").cast("bigint"))


@register("bronze_json_roundtrip")
def bronze_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{fresh_dir(spark, 'feed')}/json"
    write_dated(_feed(spark, sf_dir), root, "json", ["date"])
    return read_json(spark, root, _FEED_SCHEMA)


@register("bronze_json_inferred")
def bronze_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    root = f"{fresh_dir(spark, 'documents')}/json"
    documents.write.json(root)
    return read_json_inferred(spark, root)


@register("silver_roundtrip")
def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = distinct_rows(table(spark, sf_dir, "orders"))
    root = fresh_dir(spark, "orders")
    for _ in range(2):
        path = write_run_date(orders, root, RUN_DATE, "parquet")
    return read_parquet(spark, path)


@register("silver_write_once")
def silver_write_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{fresh_dir(spark, 'customer')}/parquet"
    write_parquet(distinct_rows(table(spark, sf_dir, "customer")), path)
    return read_parquet(spark, path)


@register("silver_generic")
def silver_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "pairs")
    write_csv(table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag"), f"{root}/csv")
    refine_table(spark, f"{root}/csv", f"{root}/parquet")
    return read_parquet(spark, f"{root}/parquet").withColumn("l_partkey", F.col("l_partkey").cast("bigint"))


@register("silver_feed")
def silver_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "feed")
    feed = _feed(spark, sf_dir).select("product_id", iso_date("date").alias("date"))
    feed.write.json(f"{root}/json")
    refine_feed(spark, f"{root}/json", f"{root}/parquet")
    return read_parquet(spark, f"{root}/parquet")


@register("silver_feed_merged")
def silver_feed_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose objects gain a field, lose another and change a type from one date to the next."""
    root = f"{fresh_dir(spark, 'feed')}/json"
    events = table(spark, sf_dir, "events").withColumn("date", F.col("ts").cast("date"))
    even = F.dayofmonth("date") % 2 == 0
    plain = events.where(even).select("event_id", F.col("user_id").alias("product_id"), "value", "date")
    rich = events.where(~even).select(
        "event_id",
        F.col("user_id").alias("product_id"),
        "event_type",
        F.concat(F.lit("v"), F.col("user_id") % 7).alias("value"),
        "date",
    )
    for part in (plain, rich):
        write_dated(part, root, "json", ["date"])
    return distinct_rows(read_json_merged(spark, root)).select(
        "event_id", "product_id", "event_type", F.col("value").isNotNull().cast("int").alias("valued"),
        F.when(F.col("value").startswith("v"), F.col("value")).alias("code"), "date",
    )


@register("silver_evolved")
def silver_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run dates of the orders with other columns: at first narrow identifiers, an old name and no priority."""
    root = f"{fresh_dir(spark, 'orders')}/parquet"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    first, second, third = (RUN_DATE + dt.timedelta(days=n) for n in range(3))
    old = orders.where("o_orderkey % 3 = 0").selectExpr(
        "CAST(o_orderkey AS INT) AS o_orderkey", "o_custkey AS customer", "o_totalprice"
    )
    write_run_date(old, root, first, "parquet")
    write_run_date(orders.where("o_orderkey % 3 = 1").drop("o_orderpriority"), root, second, "parquet")
    write_run_date(orders.where("o_orderkey % 3 = 2").withColumn("note", F.lit("x")), root, third, "parquet")
    rule = Evolution(
        orders.schema,
        added={"o_orderpriority": "unknown"},
        widened={"o_orderkey": ["int"]},
        renamed={"o_custkey": ["customer"]},
        dropped=["note"],
    )
    return read_evolved(spark, root, rule, [first, second, third])


@register("feed_by_date")
def feed_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{fresh_dir(spark, 'feed')}/json"
    write_dated(_feed(spark, sf_dir), root, "json", ["date"])
    return read_feed_dates(spark, root, _FEED_SCHEMA, FEED_DATES)


@register("feed_previous_day")
def feed_previous_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{fresh_dir(spark, 'feed')}/json"
    write_dated(_feed(spark, sf_dir), root, "json", ["date"])
    return read_feed_day_before(spark, root, _FEED_SCHEMA, RUN_DATE)


@register("partition_pruned_read")
def partition_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{fresh_dir(spark, 'events')}/parquet"
    events = table(spark, sf_dir, "events").withColumn("run_date", F.col("ts").cast("date"))
    write_dated(events, root, "parquet", ["run_date"])
    rows = read_run_date(spark, root, RUN_DATE)
    return rows.select("event_id", "user_id", "event_type", "value", iso_date("run_date").alias("run_date"))


@register("partition_year_month")
def partition_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{fresh_dir(spark, 'lineitem')}/json"
    shipped = F.col("l_shipdate")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", F.year(shipped).alias("year"), F.month(shipped).alias("month")
    )
    write_dated(lines, root, "json", ["year", "month"])
    return read_json(spark, root, lines.schema)


@register("rerun_idempotent")
def rerun_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{fresh_dir(spark, 'feed')}/json"
    feed = _feed(spark, sf_dir)
    write_dated(feed, root, "json", ["date"])
    for _ in range(2):
        write_dated(feed.where(F.col("date") == F.lit(RUN_DATE)), root, "json", ["date"])
    return read_json(spark, root, _FEED_SCHEMA)


# ---- database over JDBC -------------------------------------------------------------------------------------


def _database(spark: SparkSession) -> Database:
    """The database named in the session, or in a local session one inside its own process."""
    url = spark.conf.get("spark.tallystar.jdbc.url", None)
    if url:
        names = {"user", "password", "driver"}
        given = {n: spark.conf.get(f"spark.tallystar.jdbc.{n}", None) for n in names}
        return Database(url, {n: v for n, v in given.items() if v})
    if not is_local(spark):
        raise RuntimeError("set spark.tallystar.jdbc.url to a database that all executors can reach")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    name = f"tallystar{uuid.uuid4().hex}"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    return Database(f"jdbc:derby:memory:{name};create=true", driver)


@register("jdbc_roundtrip")
def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _database(spark)
    orders = table(spark, sf_dir, "orders")
    append_table(orders, database, "orders", "o_orderstatus VARCHAR(1), o_orderpriority VARCHAR(30)")
    return read_table(spark, database, "orders", Ranges("o_orderkey", 16))


@register("jdbc_list_tables")
def jdbc_list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List every table of a database, export each and count what was exported."""
    database = _database(spark)
    for name in ("region", "nation", "supplier", "customer"):
        df = table(spark, sf_dir, name)
        texts = [f"{f.name} VARCHAR(60)" for f in df.schema if isinstance(f.dataType, T.StringType)]
        append_table(df, database, name, ", ".join(texts))
    layout = Layout(fresh_dir(spark, "bronze"), "")
    paths = land_database(spark, database, layout, RUN_DATE)
    listed = list_tables(spark, database)
    exported = [
        read_csv_inferred(spark, path).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name, path in paths.items()
    ]
    return listed.join(union_all(*exported), "table_name")


def _clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_clients(table(spark, sf_dir, "customer"))


def _earlier_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier load brought: customers whose balance is not negative."""
    return _as_clients(table(spark, sf_dir, "customer").where("c_acctbal >= 0"))


def _as_clients(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("client_id"),
        F.col("c_name").alias("fullname"),
        F.col("c_nationkey").alias("location_area_id"),
    )


@register("dwh_append")
def dwh_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, clients = _database(spark), _clients(spark, sf_dir)
    for _ in range(2):
        append_table(clients, database, "clients_dim", "fullname VARCHAR(30)")
    return read_table(spark, database, "clients_dim")


@register("dwh_append_new")
def dwh_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, clients = _database(spark), _clients(spark, sf_dir)
    append_table(_earlier_clients(spark, sf_dir), database, "clients_dim", "fullname VARCHAR(30)")
    for _ in range(2):
        append_new_rows(clients, database, "clients_dim", ["client_id"], "fullname VARCHAR(30)")
    return read_table(spark, database, "clients_dim")


# ---- warehouse tables ---------------------------------------------------------------------------------------


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Facts by month, for the queries load all years at once, and distributed within each; dimensions are not."""
    months = table(spark, sf_dir, "lineitem").groupBy(F.trunc("l_shipdate", "MM")).count()
    buckets = {"orders_fact": bucket_count(months.agg(F.max("count")).first()[0] or 0)}
    name, location = f"shop_{uuid.uuid4().hex}", fresh_dir(spark, "warehouse")
    return Warehouse(spark, name, location, buckets, id_type="BIGINT", date_unit=100)


def _kept(warehouse: Warehouse, df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so that the database it comes from can be dropped."""
    rows = stage(df, "warehouse-rows")
    warehouse.drop()
    return rows


def _checksum(warehouse: Warehouse, name: str) -> Column:
    """A sum over all columns of all rows."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in warehouse.tables[name].column_names]
    head = F.substring(F.md5(F.concat_ws("|", *columns)), 1, 8)
    return F.sum(F.conv(head, 16, 10).cast("bigint")).alias("checksum")


@register("dwh_ddl")
def dwh_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the tables twice, load four of them, and report columns and rows of each."""
    warehouse = _warehouse(spark, sf_dir)
    for _ in range(2):
        warehouse.create()
    warehouse.append("clients_dim", _clients(spark, sf_dir))
    warehouse.append("location_areas_dim", location_dim(spark, sf_dir))
    warehouse.append("dates_dim", _dates(spark, sf_dir))
    warehouse.append("orders_fact", keyed_fact(_shop(spark, sf_dir, "orders"), warehouse.read("dates_dim"), "order_date"))
    reports = [
        warehouse.read(name).agg(
            F.lit(name).alias("table_name"),
            F.lit(warehouse.describe(name)).alias("columns"),
            F.count(F.lit(1)).alias("n_rows"),
            _checksum(warehouse, name),
        )
        for name in warehouse.tables
    ]
    return _kept(warehouse, union_all(*reports))


@register("dwh_append_new_table")
def dwh_append_new_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, clients = _warehouse(spark, sf_dir), _clients(spark, sf_dir)
    warehouse.create()
    warehouse.append("clients_dim", _earlier_clients(spark, sf_dir))
    for _ in range(2):
        warehouse.append_new("clients_dim", clients)
    return _kept(warehouse, warehouse.read("clients_dim"))


@register("dwh_dimension_unique")
def dwh_dimension_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rows for each identifier in a first load, and other attributes in a later one."""
    warehouse = _warehouse(spark, sf_dir)
    warehouse.create()
    clients = table(spark, sf_dir, "customer").selectExpr(
        "c_nationkey AS client_id", "c_name AS fullname", "c_custkey % 7 AS location_area_id"
    )
    warehouse.append_new("clients_dim", clients)
    later = clients.withColumn("fullname", F.lit("zzz"))
    warehouse.append_new("clients_dim", later.union(later.withColumn("client_id", F.col("client_id") + 1000)))
    return _kept(warehouse, warehouse.read("clients_dim"))


@register("dwh_replace_date")
def dwh_replace_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load with wrong quantities, then the dates from 1998 on corrected twice."""
    warehouse = _warehouse(spark, sf_dir)
    warehouse.create()
    orders = _shop(spark, sf_dir, "orders").withColumn("time_id", date_key("order_date"))
    warehouse.replace_dates("orders_fact", orders.withColumn("quantity", F.col("quantity") + 1))
    for _ in range(2):
        warehouse.replace_dates("orders_fact", orders.where("time_id >= 19980101"))
    return _kept(warehouse, warehouse.read("orders_fact"))


def _client_loads(spark: SparkSession, sf_dir: str) -> list[tuple[dt.date, DataFrame]]:
    """What the shop said of its clients on four days, in the order in which the loads arrive: the third is late."""
    customer = table(spark, sf_dir, "customer")
    clients, moved = _as_clients(customer), F.col("location_area_id") + 100
    debtors = _as_clients(customer.where("c_acctbal < 0"))
    building = _as_clients(customer.where("c_mktsegment = 'BUILDING'"))
    return [
        (dt.date(1992, 1, 1), clients.where("client_id % 10 <> 0")),
        (dt.date(1996, 1, 1), debtors.withColumn("location_area_id", moved)),
        (dt.date(1994, 6, 1), building.withColumn("fullname", F.concat(F.lit("late "), F.col("client_id")))),
        (dt.date(1997, 3, 1), clients.where("client_id % 10 = 0")),
    ]


def _with_history(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Every load twice, so that a repeated one must change nothing."""
    warehouse = _warehouse(spark, sf_dir)
    warehouse.create()
    for day, clients in _client_loads(spark, sf_dir):
        for _ in range(2):
            warehouse.record("clients_dim", clients, day)
    return warehouse


@register("dwh_dimension_history")
def dwh_dimension_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of the clients after changes, a late load and repeated ones, with the days between which they hold."""
    warehouse = _with_history(spark, sf_dir)
    return _kept(warehouse, warehouse.read_versions("clients_dim"))


@register("dwh_history_sales")
def dwh_history_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the location that the client had on the day of the order."""
    warehouse = _with_history(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("client_id"), _day("o_orderdate", "order_date"), "o_totalprice"
    )
    placed = join_as_of(orders, warehouse.read_versions("clients_dim"), "client_id", "order_date")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    sums = placed.groupBy("location_area_id").agg(F.count(F.lit(1)).alias("n_orders"), F.sum(cents).alias("cents"))
    return _kept(warehouse, sums)


@register("dwh_late_rows")
def dwh_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load without some lines, then late and corrected lines of old dates, twice: the other lines of the dates stay."""
    warehouse = _warehouse(spark, sf_dir)
    warehouse.create()
    orders = _shop(spark, sf_dir, "orders").withColumn("time_id", date_key("order_date"))
    warehouse.replace_dates("orders_fact", orders.where("order_id % 8 <> 1"))
    late = orders.where("order_id % 8 = 1")
    corrected = orders.where("order_id % 8 = 2").withColumn("quantity", F.col("quantity") + 1000)
    for _ in range(2):
        warehouse.merge_rows("orders_fact", late.union(corrected))
    return _kept(warehouse, warehouse.read("orders_fact"))


@register("dwh_storage")
def dwh_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the catalog says that the loaded tables are kept, and whether the loaded files are: rows, codec, distribution."""
    warehouse = _warehouse(spark, sf_dir)
    warehouse.create()
    warehouse.append("clients_dim", _clients(spark, sf_dir))
    orders = _shop(spark, sf_dir, "orders").withColumn("time_id", date_key("order_date"))
    warehouse.append("orders_fact", orders)
    reports = []
    for name in ("clients_dim", "orders_fact"):
        kept, rows = warehouse.storage(name), warehouse.read(name)
        suffixes = {".".join(path.rsplit(".", 2)[1:]) for path in rows.inputFiles()}
        text = [F.lit(kept.get(k)).alias(k) for k in ("provider", "compression", "partition_columns", "bucket_columns")]
        report = [F.lit(name).alias("table_name"), *text, F.lit(kept["n_buckets"]).cast("int").alias("n_buckets")]
        report += [F.lit(",".join(sorted(suffixes))).alias("files"), F.count(F.lit(1)).alias("n_rows")]
        reports.append(rows.agg(*report))
    return _kept(warehouse, union_all(*reports))


def _sales(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The dates and orders of the shop, with the orders by month."""
    warehouse = _warehouse(spark, sf_dir)
    warehouse.create()
    warehouse.append("dates_dim", _dates(spark, sf_dir))
    orders = _shop(spark, sf_dir, "orders").withColumn("time_id", date_key("order_date"))
    warehouse.append("orders_fact", orders)
    return warehouse


def sunday_sales(warehouse: Warehouse) -> DataFrame:
    """Quantities sold per month on the Sundays of a spring: only the files of these months are opened."""
    sundays = warehouse.read("dates_dim").where("action_year = 1995 AND action_month IN (3, 4, 5) AND action_weekday = 1")
    sold = warehouse.read_star("orders_fact", sundays)
    return sold.groupBy("action_year", "action_month").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("quantity"), F.countDistinct("time_id").alias("n_days")
    )


@register("star_month_sales")
def star_month_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _sales(spark, sf_dir)
    return _kept(warehouse, sunday_sales(warehouse))


@register("fact_orphans")
def fact_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines against dimensions that lack members: how many refer to none, and the dimensions with rows for these.

    Then the products bring half of the missing members, which fills their rows in.
    """
    warehouse = _warehouse(spark, sf_dir)
    warehouse.create()
    products = _shop(spark, sf_dir, "products")
    warehouse.append_new("products_dim", products.where("aisle_id <= 30"))
    warehouse.append_new("clients_dim", _earlier_clients(spark, sf_dir))
    orders = _shop(spark, sf_dir, "orders")
    held = {"product_id": "products_dim", "client_id": "clients_dim"}
    missing = stage(
        missing_members(orders, {c: warehouse.read(name).select(c) for c, name in held.items()}), "missing-members"
    )
    for column, name in held.items():
        warehouse.add_members(name, missing.where(F.col("dimension") == column).select("member"))
    warehouse.complete_members("products_dim", products.where("aisle_id > 30 AND product_id % 2 = 0"))
    left = missing_members(orders, {c: warehouse.read(name).select(c) for c, name in held.items()})
    counted = missing.groupBy("dimension").agg(F.count(F.lit(1)).alias("n_members"), F.sum("n_rows").alias("n_rows"))
    empty = {"product_id": F.col("product_name").isNull(), "client_id": F.col("fullname").isNull()}
    after = [
        warehouse.read(name).agg(
            F.lit(column).alias("dimension"), F.count(F.lit(1)).alias("n_dimension"), F.count_if(empty[column]).alias("n_empty")
        )
        for column, name in held.items()
    ]
    still = left.groupBy(F.col("dimension").alias("_dimension")).agg(F.count(F.lit(1)).alias("n_left"))
    report = union_all(*after).join(counted, "dimension", "left").join(still, F.col("dimension") == F.col("_dimension"), "left")
    zero = F.lit(0).cast("bigint")
    numbers = [F.coalesce(c, zero).alias(c) for c in ("n_members", "n_rows", "n_left")]
    return _kept(warehouse, report.select("dimension", *numbers, "n_dimension", "n_empty"))


@register("dwh_bucketed_join")
def dwh_bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their lines, stored bucketed by the join key and a salt for hot orders: no shuffle to join."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity", "l_extendedprice"
    )
    buckets = max(bucket_count(lines.count()), spark.sparkContext.defaultParallelism)
    # Finer salts than buckets, so that the parts of a hot order spread evenly over the buckets.
    pair, keys = salt_pair(lines, orders, "o_orderkey", parts=8 * buckets), ["o_orderkey", SALT]
    root, name = fresh_dir(spark, "bucketed"), uuid.uuid4().hex
    many = store_bucketed(pair.many, f"lines_{name}", keys, buckets, f"{root}/lines")
    one = store_bucketed(pair.one, f"orders_{name}", keys, buckets, f"{root}/orders")
    return many.hint("merge").join(one, keys).drop(SALT)


# ---- the daily job ------------------------------------------------------------------------------------------


def _shop(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the shop by name."""
    if name == "aisles":
        return table(spark, sf_dir, "nation").selectExpr("n_nationkey AS aisle_id", "n_name AS aisle")
    if name == "departments":
        return table(spark, sf_dir, "region").selectExpr("r_regionkey AS department_id", "r_name AS department")
    if name == "clients":
        return _clients(spark, sf_dir)
    if name == "products":
        return table(spark, sf_dir, "part").selectExpr(
            "p_partkey AS product_id",
            "p_name AS product_name",
            "p_size AS aisle_id",
            "CAST(replace(p_brand, 'Brand#', '') AS INT) AS department_id",
        )
    if name == "orders":
        return table(spark, sf_dir, "lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "l_suppkey AS client_id",
            "l_linenumber AS store_id",
            "CAST(l_quantity AS INT) AS quantity",
            "CAST(l_shipdate AS DATE) AS order_date",
        )
    raise KeyError(name)


@register("daily_load_end_to_end")
def daily_load_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the job twice for one date; report the rows and a checksum of each warehouse table."""
    root = fresh_dir(spark, "daily")
    layout = Layout(f"{root}/bronze", f"{root}/silver", id_type="BIGINT")
    feed = _feed(spark, sf_dir).select("product_id", "date")
    warehouse = _warehouse(spark, sf_dir)
    for _ in range(2):
        run_daily(spark, lambda name: _shop(spark, sf_dir, name), feed, layout, RUN_DATE, warehouse)
    reports = [
        warehouse.read(name).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            _checksum(warehouse, name),
        )
        for name in warehouse.tables
    ]
    return _kept(warehouse, union_all(*reports))


@register("silver_rejects")
def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land rows without a readable identifier or date; report what was rejected, stored apart and kept."""
    root = fresh_dir(spark, "rejects")
    layout = Layout(f"{root}/bronze", f"{root}/silver", id_type="BIGINT")
    for name in SHOP_TABLES:
        df = _shop(spark, sf_dir, name)
        if name == "aisles":
            df = df.withColumn("aisle_id", F.expr("if(aisle_id % 5 = 0, 'BAD', string(aisle_id))"))
        if name == "orders":
            df = df.withColumn("order_id", F.expr("if(store_id = 1, NULL, order_id)"))
            df = df.withColumn("order_date", F.expr("if(store_id = 2, '2021-13-45', string(order_date))"))
        land_table(df, layout, name, RUN_DATE)
    feed = _feed(spark, sf_dir).selectExpr("product_id", "if(event_id % 10 = 0, NULL, date) AS date")
    land_feed(feed, layout, RUN_DATE)
    rejected = refine(spark, layout, RUN_DATE)
    reports = [
        spark.read.parquet(run_path(layout.rejected(name), RUN_DATE))
        .agg(F.count(F.lit(1)).alias("n_stored"))
        .crossJoin(spark.read.parquet(run_path(layout.silver(name), RUN_DATE)).agg(F.count(F.lit(1)).alias("n_kept")))
        .select(F.lit(name).alias("input"), F.lit(n).cast("bigint").alias("n_rejected"), "n_stored", "n_kept")
        for name, n in rejected.items()
    ]
    return union_all(*reports)
