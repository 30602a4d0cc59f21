"""Seven questions about a film-rental database.

Each question exists in two readings that differ in what they compute: which joins keep empty groups, whether
groups go by identifier or by name, what is counted, how ties and NULLs are placed. ``tables`` maps the names
category, film, film_category, actor, film_actor, inventory, rental, payment, customer, address and city to
DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions import hour_component, total_hours
from tallystar.operators import (
    Arm,
    Link,
    anti_join,
    best_per_arm,
    conditional_count,
    count_pairs,
    keep_groups,
    match_groups,
    ranked_with_ties,
    roll_up,
    top_k,
)
from tallystar.operators.ranking import sort_by

Tables = Mapping[str, DataFrame]

_ACTOR_LABELS = ("first_name", "last_name")


def films_per_category(tables: Tables) -> DataFrame:
    """Distinct films of every category, empty ones included; categories of equal name stay apart."""
    links = tables["film_category"]
    counts = count_pairs(links, "category_id", "film_id", "count")
    kept = keep_groups(tables["category"], counts, "category_id", ["name"], distinct_counts=["count"])
    ordered = sort_by(kept, "count", ["category_id"])
    return ordered.select(F.col("name").alias("category_name"), "count")


def films_per_category_name(tables: Tables) -> DataFrame:
    """Rows per name of categories that have films; categories of equal name are one."""
    counts = tables["film_category"].groupBy("category_id").agg(F.count(F.lit(1)).alias("count"))
    matched = match_groups(tables["category"], counts, "category_id", ["name"], counts=["count"])
    return sort_by(matched.groupBy("name").agg(F.sum("count").alias("count")), "count", ["name"])


def most_rented_actors(tables: Tables, k: int = 10, keep_idle: bool = True) -> DataFrame:
    """Actors by distinct rentals of their films; ``keep_idle`` ranks actors without rentals too."""
    copies = tables["inventory"].select("inventory_id", "film_id")
    rented = tables["rental"].select("rental_id", "inventory_id").join(copies, "inventory_id")
    rented = rented.select("film_id", "rental_id").distinct()
    cast = tables["film_actor"].select("actor_id", "film_id").distinct()
    counts = count_pairs(cast.join(rented, "film_id"), "actor_id", "rental_id", "rental_count")
    attach = keep_groups if keep_idle else match_groups
    actors = attach(tables["actor"], counts, "actor_id", _ACTOR_LABELS, distinct_counts=["rental_count"])
    return top_k(actors, "rental_count", k, ["actor_id"])


def _spend_per_category(tables: Tables) -> DataFrame:
    paid = tables["payment"].groupBy("rental_id").agg(F.sum("amount").alias("category_amount"))
    return roll_up(
        paid,
        [
            Link(tables["rental"], "rental_id", "inventory_id"),
            Link(tables["inventory"], "inventory_id", "film_id"),
            Link(tables["film_category"], "film_id", "category_id", unique=False),
        ],
        ["category_amount"],
    )


def top_spend_category(tables: Tables, nulls_first: bool = False) -> DataFrame:
    """The category that earned most, by name. ``nulls_first`` puts a category without payments ahead."""
    spend = _spend_per_category(tables)
    kept = keep_groups(tables["category"], spend, "category_id", ["name"], sums=["category_amount"])
    best = top_k(kept, "category_amount", 1, ["category_id"], nulls_first=nulls_first)
    return best.select(F.col("name").alias("category_name"), "category_amount")


def top_spend_category_ids(tables: Tables, k: int = 10) -> DataFrame:
    """The k categories that earned most, by identifier; only categories with payments."""
    spend = _spend_per_category(tables)
    matched = match_groups(tables["category"], spend, "category_id", sums=["category_amount"])
    return top_k(matched, "category_amount", k, ["category_id"])


def films_not_in_stock(tables: Tables, titles_only: bool = False) -> DataFrame:
    missing = anti_join(tables["film"], tables["inventory"], "film_id", "film_id")
    return missing.select("title") if titles_only else missing


def top_actors_in_category(
    tables: Tables, category: str = "Children", k: int = 3, descending: bool = True
) -> DataFrame:
    """Actors whose number of films in one category ranks up to k, all tied actors included."""
    chosen = tables["category"].where(F.col("name") == category).select("category_id")
    films = tables["film_category"].join(chosen, "category_id").groupBy("film_id")
    films = films.agg(F.count("film_id").alias("films_count"))
    counts = roll_up(films, [Link(tables["film_actor"], "film_id", "actor_id", unique=False)], ["films_count"])
    actors = match_groups(tables["actor"], counts, "actor_id", _ACTOR_LABELS, counts=["films_count"])
    ranked = ranked_with_ties(actors, "films_count", k, descending, "rank")
    return ranked.select("actor_id", *_ACTOR_LABELS)


def customers_per_city(tables: Tables, by_name: bool = True, sort_column: str = "inactive_count") -> DataFrame:
    """Active and inactive customers. By name all cities are kept; by identifier only those with customers."""
    values = ["active_count", "inactive_count"]
    active = F.col("active")
    per_address = tables["customer"].groupBy("address_id").agg(
        conditional_count(active == 1).alias(values[0]), conditional_count(active == 0).alias(values[1])
    )
    per_city = roll_up(per_address, [Link(tables["address"], "address_id", "city_id")], values)
    if not by_name:
        matched = match_groups(tables["city"], per_city, "city_id", counts=values)
        return sort_by(matched, sort_column, ["city_id"])
    kept = keep_groups(tables["city"], per_city, "city_id", ["city"], counts=values)
    named = kept.groupBy("city").agg(*(F.sum(v).alias(v) for v in values))
    return sort_by(named, sort_column, ["city"])


def _best_by_city(tables: Tables, starts: Column, has_hyphen: Column, measure: Column) -> DataFrame:
    """The category with the largest measure over rentals of customers in two sets of cities."""
    cities = tables["city"].select("city_id", starts.alias("_starts"), has_hyphen.alias("_hyphen"))
    cities = cities.where(F.col("_starts") | F.col("_hyphen"))
    homes = tables["address"].select("address_id", "city_id").join(cities, "city_id")
    renters = tables["customer"].select("customer_id", "address_id").join(homes, "address_id")
    renters = renters.select("customer_id", "_starts", "_hyphen")
    rentals = tables["rental"].select("inventory_id", "customer_id", measure.alias("_measure"))
    per_copy = rentals.join(renters, "customer_id").groupBy("inventory_id")
    values = ["_starts_sum", "_starts_rows", "_hyphen_sum", "_hyphen_rows"]
    per_copy = per_copy.agg(
        F.sum(F.when(F.col("_starts"), F.col("_measure"))).alias(values[0]),
        F.count_if(F.col("_starts")).alias(values[1]),
        F.sum(F.when(F.col("_hyphen"), F.col("_measure"))).alias(values[2]),
        F.count_if(F.col("_hyphen")).alias(values[3]),
    )
    per_category = roll_up(
        per_copy,
        [
            Link(tables["inventory"], "inventory_id", "film_id"),
            Link(tables["film_category"], "film_id", "category_id", unique=False),
        ],
        values,
    )
    totals = match_groups(
        tables["category"], per_category, "category_id", ["name"], counts=values[1::2], sums=values[0::2]
    )
    arms = [Arm("starts", values[0], values[1]), Arm("hyphen", values[2], values[3])]
    return best_per_arm(totals, "category_id", ["name"], arms)


def longest_rented_category_names(tables: Tables) -> DataFrame:
    """By the hour field of each rental's length, city patterns in any case; one row if both sets agree."""
    city = F.col("city")
    measure = hour_component("rental_date", "return_date")
    return _best_by_city(tables, city.ilike("a%"), city.ilike("%-%"), measure).select("name").distinct()


def longest_rented_category_hours(tables: Tables) -> DataFrame:
    """By total hours, city patterns in exact case; a row for each of the two sets."""
    city = F.col("city")
    measure = total_hours("rental_date", "return_date")
    best = _best_by_city(tables, city.like("a%"), city.like("%-%"), measure)
    return best.select("category_id", F.col("value").alias("hours"))
