"""What each registered query must return, as SQL over the given tables. Used only to check results."""

from __future__ import annotations

_TOP_SUPPLIERS = """
    SELECT s.s_suppkey, s.s_name, count(DISTINCT o.o_orderkey) AS order_count
    FROM supplier s
    {how} JOIN lineitem l ON l.l_suppkey = s.s_suppkey
    {how} JOIN orders o ON o.o_orderkey = l.l_orderkey
    GROUP BY s.s_suppkey, s.s_name
    ORDER BY order_count DESC, s.s_suppkey LIMIT 10
"""

_MISSING_ORDERS = """
    SELECT o.* FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""

_RANKED = """
    WITH counted AS (
        SELECT o.o_custkey, count(l.l_partkey) AS cnt, rank() OVER (ORDER BY count(l.l_partkey) {order}) AS rnk
        FROM orders o
        JOIN lineitem l ON l.l_orderkey = o.o_orderkey
        JOIN part p ON p.p_partkey = l.l_partkey
        WHERE p.p_type = 'ECONOMY'
        GROUP BY o.o_custkey
    )
    SELECT o_custkey, cnt, rnk FROM counted WHERE rnk <= 3
"""

_TOP_REGION = """
    SELECT name FROM (
        SELECT r.r_name AS name
        FROM region r
        JOIN nation n ON n.n_regionkey = r.r_regionkey
        JOIN customer c ON c.c_nationkey = n.n_nationkey
        JOIN orders o ON o.o_custkey = c.c_custkey
        WHERE {condition}
        GROUP BY r.r_regionkey, r.r_name
        ORDER BY sum(o.o_totalprice) DESC NULLS LAST, r.r_regionkey LIMIT 1
    ) t
"""

_SPANS = "SELECT event_type, user_id, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY event_type, user_id"

_DATES = """
    SELECT DISTINCT
        CAST(strftime(d, '%Y%m%d') AS BIGINT) AS time_id,
        d AS action_date,
        CAST(weekofyear(d) AS INT) AS action_week,
        CAST(month(d) AS INT) AS action_month,
        CAST(year(d) AS INT) AS action_year,
        CAST(dayofweek(d) + 1 AS INT) AS action_weekday
    FROM (
        SELECT CAST(o_orderdate AS DATE) AS d FROM orders
        UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem
    ) t
"""

_FEED = "SELECT user_id AS product_id, event_id, CAST(ts AS DATE) AS date FROM events"

_CLIENTS = "SELECT c_custkey AS client_id, c_name AS fullname, c_nationkey AS location_area_id FROM customer"

_SHOP_ORDERS = """
    SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INT) AS quantity,
        CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS time_id
    FROM lineitem
"""

_COLUMNS = {
    "clients_dim": "client_id bigint, fullname varchar(30), location_area_id bigint",
    "products_dim": "product_id bigint, product_name varchar(130), aisle_id bigint, department_id bigint",
    "aisles_dim": "aisle_id bigint, aisle varchar(30)",
    "departments_dim": "department_id bigint, department varchar(30)",
    "dates_dim": (
        "time_id bigint, action_date date, action_week int, action_month int, action_year int, action_weekday int"
    ),
    "location_areas_dim": "location_area_id bigint",
    "orders_fact": (
        "order_id bigint, product_id bigint, client_id bigint, store_id bigint, quantity int, time_id bigint"
    ),
    "out_of_stock_fact": "time_id bigint, product_id bigint",
}


def _report(name: str, rows: str | None, columns: bool = False) -> str:
    """Rows of a warehouse table and a checksum over all of its columns; no rows: an empty table."""
    names = [c.split()[0] for c in _COLUMNS[name].split(", ")]
    source = rows or f"SELECT {', '.join(f'NULL AS {n}' for n in names)} WHERE false"
    text = ", ".join(f"coalesce(CAST({n} AS VARCHAR), '')" for n in names)
    declared = f"'{_COLUMNS[name]}' AS columns, " if columns else ""
    return f"""
        SELECT '{name}' AS table_name, {declared}count(*) AS n_rows,
            CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 8) AS BIGINT)) AS BIGINT) AS checksum
        FROM ({source}) t
    """


# Versions of the clients: what each load said, the changes among it by day, and the day of the next change.
_VERSIONS = """
    SELECT client_id, fullname, location_area_id, valid_from,
        CAST(lead(valid_from) OVER (PARTITION BY client_id ORDER BY valid_from) AS DATE) AS valid_to
    FROM (
        SELECT *, lag(fullname || '|' || location_area_id) OVER (PARTITION BY client_id ORDER BY valid_from) AS before
        FROM (
            SELECT c_custkey AS client_id, c_name AS fullname, CAST(c_nationkey AS BIGINT) AS location_area_id,
                DATE '1992-01-01' AS valid_from
            FROM customer WHERE c_custkey % 10 <> 0
            UNION ALL SELECT c_custkey, c_name, c_nationkey + 100, DATE '1996-01-01' FROM customer WHERE c_acctbal < 0
            UNION ALL SELECT c_custkey, 'late ' || c_custkey, c_nationkey, DATE '1994-06-01'
            FROM customer WHERE c_mktsegment = 'BUILDING'
            UNION ALL SELECT c_custkey, c_name, c_nationkey, DATE '1997-03-01' FROM customer WHERE c_custkey % 10 = 0
        ) loads
    ) days
    WHERE before IS NULL OR before <> fullname || '|' || location_area_id
"""
_AREAS = "SELECT DISTINCT c_nationkey AS location_area_id FROM customer"
_ORDERS_FACT = _SHOP_ORDERS.replace("l_orderkey,", "l_orderkey AS order_id,").replace(
    "l_partkey, l_suppkey, l_linenumber,", "l_partkey AS product_id, l_suppkey AS client_id, l_linenumber AS store_id,"
)
_LOADED = {"clients_dim": _CLIENTS, "dates_dim": _DATES, "location_areas_dim": _AREAS, "orders_fact": _ORDERS_FACT}
_JOB = {
    "clients_dim": _CLIENTS,
    "products_dim": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_size AS aisle_id,
            CAST(replace(p_brand, 'Brand#', '') AS INT) AS department_id
        FROM part
    """,
    "aisles_dim": "SELECT n_nationkey AS aisle_id, n_name AS aisle FROM nation",
    "departments_dim": "SELECT r_regionkey AS department_id, r_name AS department FROM region",
    "dates_dim": _DATES.replace("CAST(o_orderdate AS DATE) AS d FROM orders", "CAST(ts AS DATE) AS d FROM events"),
    "location_areas_dim": _AREAS,
    "orders_fact": _ORDERS_FACT,
    "out_of_stock_fact": """
        SELECT DISTINCT CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS time_id, user_id AS product_id FROM events
    """,
}

_LONGEST = """
    SELECT category_id, hours FROM (
        SELECT c.n_nationkey AS category_id, CAST(sum(o.o_orderkey % 200) AS DOUBLE) AS hours
        FROM nation c
        JOIN part p ON p.p_size = c.n_nationkey
        JOIN lineitem l ON l.l_partkey = p.p_partkey
        JOIN orders o ON o.o_orderkey = l.l_orderkey
        JOIN customer u ON u.c_custkey = o.o_custkey
        JOIN customer a ON a.c_custkey = u.c_custkey
        JOIN (
            SELECT n_nationkey,
                CASE WHEN n_nationkey % 2 = 0 THEN 'a' || n_name ELSE replace(n_name, '_', '-') END AS city
            FROM nation
        ) t ON t.n_nationkey = a.c_nationkey
        WHERE t.city LIKE '{pattern}'
        GROUP BY c.n_nationkey
        ORDER BY hours DESC, c.n_nationkey LIMIT 1
    ) x
"""


def _rejects(name: str, table: str, bad: str, columns: str) -> str:
    return f"""
        SELECT '{name}' AS input, count(*) FILTER (WHERE {bad}) AS n_rejected, count(*) FILTER (WHERE {bad}) AS n_stored,
            (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {table} WHERE NOT ({bad})) d) AS n_kept
        FROM {table}
    """


ORACLE_SQL: dict[str, str] = {
    "distinct_count_outer": """
        SELECT n.n_nationkey, n.n_name, count(DISTINCT l.l_partkey) AS part_count
        FROM nation n
        LEFT JOIN supplier s ON n.n_nationkey = s.s_nationkey AND s.s_acctbal > 8000
        LEFT JOIN lineitem l ON l.l_suppkey = s.s_suppkey
        GROUP BY n.n_nationkey, n.n_name
    """,
    "rowcount_inner": """
        SELECT n.n_name, count(*) AS cnt
        FROM nation n JOIN supplier s ON n.n_nationkey = s.s_nationkey AND s.s_acctbal > 8000
        GROUP BY n.n_name
    """,
    "topn_distinct": _TOP_SUPPLIERS.format(how="LEFT"),
    "topn_inner": _TOP_SUPPLIERS.format(how="INNER"),
    "conditional_counts": """
        SELECT n.n_name, count(CASE WHEN c.c_acctbal >= 0 THEN 1 END) AS active_count,
            count(CASE WHEN c.c_acctbal < 0 THEN 1 END) AS inactive_count
        FROM nation n LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey
        GROUP BY n.n_name
    """,
    "top1_sum": """
        SELECT r.r_name, round(sum(l.l_extendedprice), 2) AS amt
        FROM region r
        LEFT JOIN nation n ON n.n_regionkey = r.r_regionkey
        LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey
        LEFT JOIN orders o ON o.o_custkey = c.c_custkey
        LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
        GROUP BY r.r_regionkey, r.r_name
        ORDER BY sum(l.l_extendedprice) DESC NULLS LAST LIMIT 1
    """,
    "topn_sum_inner": """
        SELECT n.n_nationkey, round(sum(l.l_extendedprice), 2) AS amt
        FROM nation n
        JOIN customer c ON c.c_nationkey = n.n_nationkey
        JOIN orders o ON o.o_custkey = c.c_custkey
        JOIN lineitem l ON l.l_orderkey = o.o_orderkey
        GROUP BY n.n_nationkey
        ORDER BY sum(l.l_extendedprice) DESC, n.n_nationkey LIMIT 10
    """,
    "top1_sum_nulls_first": """
        SELECT o.o_orderkey, sum(l.l_quantity) AS qty
        FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
        GROUP BY o.o_orderkey
        ORDER BY qty DESC NULLS FIRST, o.o_orderkey LIMIT 1
    """,
    "anti_join": _MISSING_ORDERS,
    "anti_join_sql": _MISSING_ORDERS,
    "rank_ties": _RANKED.format(order="DESC"),
    "rank_ties_asc": _RANKED.format(order="ASC"),
    "union_top1": _TOP_REGION.format(condition="c.c_mktsegment ILIKE '%u%'")
    + " UNION "
    + _TOP_REGION.format(condition="o.o_orderpriority ILIKE '%-%'"),
    "union_all_top1": _TOP_REGION.format(condition="c.c_mktsegment LIKE '%U%'")
    + " UNION ALL "
    + _TOP_REGION.format(condition="o.o_orderpriority LIKE '%-%'"),
    "like_vs_ilike": """
        SELECT count(*) FILTER (WHERE c_mktsegment LIKE 'a%') AS n_like,
            count(*) FILTER (WHERE c_mktsegment ILIKE 'a%') AS n_ilike
        FROM customer
    """,
    "hour_part": f"SELECT event_type, user_id, CAST(date_part('hour', hi - lo) AS BIGINT) AS h FROM ({_SPANS}) t",
    "hour_part_sum": f"""
        SELECT event_type, CAST(sum(date_part('hour', hi - lo)) AS BIGINT) AS h FROM ({_SPANS}) t GROUP BY event_type
    """,
    "total_hours": f"""
        SELECT event_type, user_id, date_diff('second', lo, hi) / 3600.0 AS h FROM ({_SPANS}) t
    """,
    "total_hours_sum": f"""
        SELECT event_type, round(sum(date_diff('second', lo, hi)) / 3600.0, 6) AS h FROM ({_SPANS}) t
        GROUP BY event_type
    """,
    "distinct_rows": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "date_dim": _DATES,
    "location_dim": "SELECT DISTINCT c_nationkey AS location_area_id FROM customer",
    "fact_keyed": """
        SELECT DISTINCT o_orderkey, o_custkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS time_id FROM orders
    """,
    "feed_fact_keyed": """
        SELECT DISTINCT CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS time_id, l_partkey AS product_id
        FROM lineitem
    """,
    "bronze_csv_roundtrip": "SELECT doc_id, text, lang FROM documents",
    "bronze_csv_inferred": """
        SELECT l_partkey, l_quantity, l_extendedprice, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate
        FROM lineitem
    """,
    "bronze_json_roundtrip": _FEED,
    "bronze_json_inferred": "SELECT doc_id, text, lang FROM documents",
    "silver_roundtrip": "SELECT DISTINCT * FROM orders",
    "silver_write_once": "SELECT DISTINCT * FROM customer",
    "silver_generic": "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem",
    "silver_feed": "SELECT DISTINCT user_id AS product_id, strftime(ts, '%Y-%m-%d') AS date FROM events",
    "feed_by_date": f"SELECT * FROM ({_FEED}) t WHERE date BETWEEN DATE '2024-01-02' AND DATE '2024-01-05'",
    "feed_previous_day": f"SELECT * FROM ({_FEED}) t WHERE date = DATE '2024-01-02'",
    "partition_pruned_read": """
        SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS run_date
        FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-03'
    """,
    "partition_year_month": """
        SELECT l_orderkey, l_partkey, l_quantity, CAST(year(l_shipdate) AS INT) AS year,
            CAST(month(l_shipdate) AS INT) AS month
        FROM lineitem
    """,
    "rerun_idempotent": _FEED,
    "jdbc_roundtrip": "SELECT * FROM orders",
    "jdbc_list_tables": """
        SELECT 'REGION' AS table_name, count(*) AS n_rows FROM region
        UNION ALL SELECT 'NATION', count(*) FROM nation
        UNION ALL SELECT 'SUPPLIER', count(*) FROM supplier
        UNION ALL SELECT 'CUSTOMER', count(*) FROM customer
    """,
    "dwh_append": f"{_CLIENTS} UNION ALL {_CLIENTS}",
    "dwh_append_new": _CLIENTS,
    "dwh_append_new_table": """
        SELECT c_custkey AS client_id, c_name AS fullname, CAST(c_nationkey AS BIGINT) AS location_area_id
        FROM customer
    """,
    "dwh_ddl": " UNION ALL ".join(_report(name, _LOADED.get(name), columns=True) for name in _COLUMNS),
    "dwh_dimension_unique": """
        SELECT CAST(c_nationkey AS BIGINT) AS client_id, max(c_name) AS fullname,
            arg_max(c_custkey % 7, c_name) AS location_area_id
        FROM customer GROUP BY c_nationkey
        UNION ALL SELECT CAST(c_nationkey + 1000 AS BIGINT), 'zzz', max(c_custkey % 7) FROM customer GROUP BY c_nationkey
    """,
    "dwh_replace_date": """
        SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS client_id,
            CAST(l_linenumber AS BIGINT) AS store_id,
            CAST(CAST(l_quantity AS INT) + CASE WHEN year(l_shipdate) < 1998 THEN 1 ELSE 0 END AS INT) AS quantity,
            CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS time_id
        FROM lineitem
    """,
    "rank_all": """
        SELECT l_orderkey, l_linenumber, l_extendedprice, rank() OVER (ORDER BY l_extendedprice DESC NULLS LAST) AS rnk
        FROM lineitem
    """,
    "silver_feed_merged": """
        SELECT DISTINCT event_id, user_id AS product_id, CASE WHEN odd THEN event_type END AS event_type,
            CAST(odd OR value IS NOT NULL AS INT) AS valued, CASE WHEN odd THEN 'v' || (user_id % 7) END AS code, date
        FROM (SELECT *, CAST(ts AS DATE) AS date, day(ts) % 2 = 1 AS odd FROM events) t
    """,
    "silver_evolved": """
        SELECT o_orderkey, o_custkey, o_totalprice,
            CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority ELSE 'unknown' END AS o_orderpriority,
            CAST(DATE '2024-01-03' + CAST(o_orderkey % 3 AS INT) AS DATE) AS run_date
        FROM orders
    """,
    "dwh_dimension_history": _VERSIONS,
    "dwh_history_sales": f"""
        SELECT v.location_area_id, count(*) AS n_orders, CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM orders o JOIN ({_VERSIONS}) v ON v.client_id = o.o_custkey AND CAST(o.o_orderdate AS DATE) >= v.valid_from
            AND (v.valid_to IS NULL OR CAST(o.o_orderdate AS DATE) < v.valid_to)
        GROUP BY v.location_area_id
    """,
    "dwh_late_rows": """
        SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS client_id,
            CAST(l_linenumber AS BIGINT) AS store_id,
            CAST(CAST(l_quantity AS INT) + CASE WHEN l_orderkey % 8 = 2 THEN 1000 ELSE 0 END AS INT) AS quantity,
            CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS time_id
        FROM lineitem
    """,
    "dwh_storage": """
        SELECT 'clients_dim' AS table_name, 'parquet' AS provider, 'gzip' AS compression, '' AS partition_columns,
            '' AS bucket_columns, 0 AS n_buckets, 'gz.parquet' AS files, count(*) AS n_rows
        FROM customer
        UNION ALL
        SELECT 'orders_fact', 'parquet', 'gzip', 'date_period', 'order_id,product_id,client_id,store_id',
            CAST(max(n_buckets) AS INT), 'gz.parquet', CAST(sum(n) AS BIGINT)
        FROM (
            SELECT count(*) AS n, ceil(max(count(*)) OVER () / 4000000.0) AS n_buckets
            FROM lineitem GROUP BY date_trunc('month', l_shipdate)
        ) t
    """,
    "star_month_sales": """
        SELECT CAST(year(d) AS INT) AS action_year, CAST(month(d) AS INT) AS action_month, count(*) AS n_lines,
            CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS quantity, count(DISTINCT d) AS n_days
        FROM (SELECT CAST(l_shipdate AS DATE) AS d, l_quantity FROM lineitem) t
        WHERE year(d) = 1995 AND month(d) IN (3, 4, 5) AND dayofweek(d) = 0
        GROUP BY year(d), month(d)
    """,
    "fact_orphans": """
        WITH lost AS (
            SELECT 'product_id' AS dimension, l_partkey AS member, p_name IS NOT NULL AND l_partkey % 2 = 0 AS brought
            FROM lineitem LEFT JOIN part ON p_partkey = l_partkey WHERE p_size IS NULL OR p_size > 30
            UNION ALL
            SELECT 'client_id', l_suppkey, false FROM lineitem
            WHERE l_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
        ), sums AS (
            SELECT dimension, count(DISTINCT member) AS n_members, count(*) AS n_rows,
                count(DISTINCT member) FILTER (WHERE NOT brought) AS n_empty
            FROM lost GROUP BY dimension
        ), held AS (
            SELECT 'product_id' AS dimension, (SELECT count(*) FROM part WHERE p_size <= 30
                OR (p_size > 30 AND p_partkey % 2 = 0)
                OR (p_partkey IN (SELECT l_partkey FROM lineitem))) AS n
            UNION ALL SELECT 'client_id', (SELECT count(*) FROM customer WHERE c_acctbal >= 0)
                + (SELECT count(DISTINCT member) FROM lost WHERE dimension = 'client_id')
        )
        SELECT h.dimension, coalesce(n_members, 0) AS n_members, coalesce(n_rows, 0) AS n_rows,
            CAST(0 AS BIGINT) AS n_left, h.n AS n_dimension, coalesce(n_empty, 0) AS n_empty
        FROM held h LEFT JOIN sums s ON s.dimension = h.dimension
    """,
    "dwh_bucketed_join": """
        SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, l.l_partkey, l.l_quantity, l.l_extendedprice
        FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    """,
    "daily_load_end_to_end": " UNION ALL ".join(_report(name, rows) for name, rows in _JOB.items()),
    "silver_rejects": " UNION ALL ".join(
        _rejects(*parts)
        for parts in (
            ("products", "part", "p_partkey IS NULL", "p_partkey, p_name, p_size, p_brand"),
            ("aisles", "nation", "n_nationkey % 5 = 0", "n_nationkey, n_name"),
            ("departments", "region", "r_regionkey IS NULL", "r_regionkey, r_name"),
            ("clients", "customer", "c_custkey IS NULL", "c_custkey, c_name, c_nationkey"),
            (
                "orders",
                "lineitem",
                "l_linenumber IN (1, 2)",
                "l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INT), CAST(l_shipdate AS DATE)",
            ),
            ("out_of_stock", "events", "event_id % 10 = 0", "user_id, CAST(ts AS DATE)"),
        )
    ),
    "rank_ties_large": """
        SELECT * FROM (
            SELECT l_orderkey, l_partkey, l_extendedprice, rank() OVER (ORDER BY l_extendedprice DESC) AS rnk FROM lineitem
        ) t WHERE rnk <= 150000
    """,
    "longest_rented": _LONGEST.format(pattern="a%") + " UNION ALL " + _LONGEST.format(pattern="%-%"),
    "bronze_csv_single_column": "SELECT nullif(l_returnflag, 'A') AS flag FROM lineitem",
}
