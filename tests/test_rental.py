"""The seven film-rental questions, both readings, against DuckDB on hand-made and random rows."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pytest

from tallystar.plans import rental

SCHEMAS = {
    "category": "category_id int, name string",
    "film": "film_id int, title string",
    "film_category": "film_id int, category_id int",
    "actor": "actor_id int, first_name string, last_name string",
    "film_actor": "actor_id int, film_id int",
    "inventory": "inventory_id int, film_id int",
    "rental": "rental_id int, inventory_id int, customer_id int, rental_date timestamp_ntz, return_date timestamp_ntz",
    "payment": "rental_id int, amount decimal(5,2)",
    "customer": "customer_id int, address_id int, active int",
    "address": "address_id int, city_id int",
    "city": "city_id int, city string",
}

AT = dt.datetime(2005, 5, 24, 22, 0, 0)


def _hours(n):
    return AT + dt.timedelta(hours=n)


# Category 4 has no film, category 3 a film without payments, categories 1 and 5 share a name, actors 2 to 5 tie at
# the third place, rental 3 lasts over four days, rental 4 was not returned, two cities share a name.
HAND_MADE = {
    "category": [(1, "Children"), (2, "Drama"), (3, "Travel"), (4, "Empty"), (5, "Drama")],
    "film": [(1, "A"), (2, "B"), (3, "C"), (4, "D"), (5, "E"), (6, "F")],
    "film_category": [(1, 1), (2, 1), (3, 2), (4, 3), (5, 5), (6, 1)],
    "actor": [(i, f"first{i}", f"last{i}") for i in range(1, 8)],
    "film_actor": [(1, 1), (1, 2), (1, 6), (2, 1), (2, 2), (3, 1), (4, 2), (5, 6), (6, 3), (6, 5)],
    "inventory": [(10, 1), (11, 1), (12, 2), (13, 3), (14, 4), (15, 5)],
    "rental": [
        (1, 10, 1, AT, _hours(5)),
        (2, 11, 2, AT, _hours(30)),
        (3, 13, 1, AT, _hours(99.5)),
        (4, 13, 3, AT, None),
        (5, 12, 4, AT, _hours(7)),
        (6, 15, 2, AT, _hours(2)),
    ],
    "payment": [(1, Decimal("2.99")), (2, Decimal("0.99")), (3, Decimal("4.99")), (5, None), (6, Decimal("9.99"))],
    "customer": [(1, 1, 1), (2, 2, 0), (3, 3, 1), (4, 4, 0), (5, 4, None)],
    "address": [(1, 1), (2, 2), (3, 3), (4, 4), (5, 6)],
    "city": [(1, "Aden"), (2, "al-Ayn"), (3, "a-b"), (4, "Oslo"), (5, "Aden"), (6, "Nowhere")],
}


def _random_tables(seed):
    rng = random.Random(seed)

    def maybe(value, chance=0.1):
        return None if rng.random() < chance else value

    def hot(low, high):
        return low if rng.random() < 0.33 else rng.randint(low, high)

    return {
        "category": [(i, rng.choice(["Children", "Drama", "Travel", "Music"])) for i in range(1, 9)],
        "film": [(i, f"film{i}") for i in range(1, 41)],
        "film_category": [(maybe(hot(1, 40), 0.05), maybe(rng.randint(1, 9), 0.05)) for _ in range(60)],
        "actor": [(i, f"first{i % 7}", f"last{i % 5}") for i in range(1, 31)],
        "film_actor": [(rng.randint(1, 32), hot(1, 40)) for _ in range(120)],
        "inventory": [(i, maybe(hot(1, 40))) for i in range(1, 101)],
        "rental": [
            (rng.randint(1, 400), maybe(hot(1, 110)), maybe(rng.randint(1, 40)), AT, maybe(_hours(rng.uniform(0, 200))))
            for _ in range(500)
        ],
        "payment": [(rng.randint(1, 420), maybe(Decimal(rng.randint(0, 1999)) / 100)) for _ in range(600)],
        "customer": [(i, maybe(rng.randint(1, 25)), rng.choice([0, 1, None])) for i in range(1, 41)],
        "address": [(i, maybe(hot(1, 12))) for i in range(1, 25)],
        "city": [(i, rng.choice(["Aden", "al-Ayn", "a-b", "Oslo", "Aa", "x-y", "abc"])) for i in range(1, 14)],
    }


@pytest.fixture(scope="module", params=["hand", 1, 2])
def world(spark, request):
    rows = HAND_MADE if request.param == "hand" else _random_tables(request.param)
    tables = {name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()}
    duck = duckdb.connect()
    for name, schema in SCHEMAS.items():
        columns = schema.replace("timestamp_ntz", "timestamp").replace(" string", " varchar")
        duck.execute(f"CREATE TABLE {name} ({columns})")
        duck.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[name][0]))})", rows[name])
    return tables, duck


def _check(df, duck, sql):
    expected = duck.execute(sql)
    assert df.columns == [d[0] for d in expected.description]

    def rounded(rows):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)

    assert rounded(tuple(r) for r in df.collect()) == rounded(expected.fetchall())


def test_films_per_category(world):
    tables, duck = world
    _check(
        rental.films_per_category(tables),
        duck,
        "SELECT name AS category_name, count(DISTINCT film_id) AS count FROM category LEFT JOIN film_category "
        "USING (category_id) GROUP BY category_id, name",
    )
    _check(
        rental.films_per_category_name(tables),
        duck,
        "SELECT name, count(*) AS count FROM category JOIN film_category USING (category_id) GROUP BY name",
    )


def test_most_rented_actors(world):
    tables, duck = world
    for keep_idle, how in ((True, "LEFT JOIN"), (False, "JOIN")):
        _check(
            rental.most_rented_actors(tables, keep_idle=keep_idle),
            duck,
            f"SELECT a.actor_id, first_name, last_name, count(DISTINCT rental_id) AS rental_count FROM actor a "
            f"{how} film_actor fa ON fa.actor_id = a.actor_id {how} inventory i ON i.film_id = fa.film_id "
            f"{how} rental r ON r.inventory_id = i.inventory_id GROUP BY ALL ORDER BY rental_count DESC, 1 LIMIT 10",
        )


def test_top_spend(world):
    tables, duck = world
    chain = (
        "FROM category c {how} JOIN film_category fc ON fc.category_id = c.category_id "
        "{how} JOIN inventory i ON i.film_id = fc.film_id {how} JOIN rental r ON r.inventory_id = i.inventory_id "
        "{how} JOIN payment p ON p.rental_id = r.rental_id"
    )
    for nulls in ("LAST", "FIRST"):
        _check(
            rental.top_spend_category(tables, nulls_first=nulls == "FIRST"),
            duck,
            f"SELECT category_name, category_amount FROM (SELECT c.category_id, name AS category_name, "
            f"sum(amount) AS category_amount {chain.format(how='LEFT')} GROUP BY c.category_id, name "
            f"ORDER BY category_amount DESC NULLS {nulls}, c.category_id LIMIT 1) t",
        )
    _check(
        rental.top_spend_category_ids(tables),
        duck,
        f"SELECT c.category_id, sum(amount) AS category_amount {chain.format(how='INNER')} GROUP BY c.category_id "
        "ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10",
    )


def test_films_not_in_stock(world):
    tables, duck = world
    where = "FROM film f WHERE NOT EXISTS (SELECT 1 FROM inventory i WHERE i.film_id = f.film_id)"
    _check(rental.films_not_in_stock(tables), duck, f"SELECT * {where}")
    _check(rental.films_not_in_stock(tables, titles_only=True), duck, f"SELECT title {where}")


def test_top_actors_in_category(world):
    tables, duck = world
    for descending, order in ((True, "DESC"), (False, "ASC")):
        _check(
            rental.top_actors_in_category(tables, descending=descending),
            duck,
            "SELECT actor_id, first_name, last_name FROM (SELECT a.actor_id, first_name, last_name, "
            f"rank() OVER (ORDER BY count(fc.film_id) {order}) AS r FROM actor a JOIN film_actor fa USING (actor_id) "
            "JOIN film_category fc ON fc.film_id = fa.film_id JOIN category c USING (category_id) "
            "WHERE c.name = 'Children' GROUP BY ALL) t WHERE r <= 3",
        )


def test_customers_per_city(world):
    tables, duck = world
    counts = (
        "count(CASE active WHEN 1 THEN 1 END) AS active_count, count(CASE active WHEN 0 THEN 1 END) AS inactive_count"
    )
    _check(
        rental.customers_per_city(tables),
        duck,
        f"SELECT city, {counts} FROM city LEFT JOIN address USING (city_id) LEFT JOIN customer USING (address_id) "
        "GROUP BY city",
    )
    _check(
        rental.customers_per_city(tables, by_name=False),
        duck,
        f"SELECT city_id, {counts} FROM city JOIN address USING (city_id) JOIN customer USING (address_id) "
        "GROUP BY city_id",
    )


def test_customers_per_city_order(world):
    tables, _ = world
    for column in ("inactive_count", "active_count"):
        rows = [r[column] for r in rental.customers_per_city(tables, sort_column=column).collect()]
        assert rows == sorted(rows, reverse=True)


def _arm(select, measure, condition):
    return (
        f"(SELECT {select} FROM (SELECT c.category_id, c.name, sum({measure}) AS m FROM category c "
        "JOIN film_category fc ON fc.category_id = c.category_id JOIN inventory i ON i.film_id = fc.film_id "
        "JOIN rental r ON r.inventory_id = i.inventory_id JOIN customer cu ON cu.customer_id = r.customer_id "
        "JOIN address a ON a.address_id = cu.address_id JOIN city ct ON ct.city_id = a.city_id "
        f"WHERE {condition} GROUP BY c.category_id, c.name ORDER BY m DESC NULLS LAST, c.category_id LIMIT 1) t)"
    )


def test_longest_rented_categories(world):
    tables, duck = world
    field = "date_part('hour', return_date - rental_date)"
    _check(
        rental.longest_rented_category_names(tables),
        duck,
        _arm("name", field, "city ILIKE 'a%'") + " UNION " + _arm("name", field, "city ILIKE '%-%'"),
    )
    hours = "(floor(epoch(return_date)) - floor(epoch(rental_date))) / 3600"
    columns = "category_id, m AS hours"
    _check(
        rental.longest_rented_category_hours(tables),
        duck,
        _arm(columns, hours, "city LIKE 'a%'") + " UNION ALL " + _arm(columns, hours, "city LIKE '%-%'"),
    )
