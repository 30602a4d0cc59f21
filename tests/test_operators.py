from __future__ import annotations

import contextlib
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystar.plans.bindings import REGISTRY
from tallystar.operators import (
    Arm,
    Link,
    anti_join,
    anti_join_sql,
    best_per_arm,
    count_pairs,
    distinct_rows,
    keep_groups,
    lookup,
    match_groups,
    rank_all,
    ranked_with_ties,
    roll_up,
    salt_pair,
    salted_join,
    top_k,
    union_all,
    union_distinct,
)
from tallystar.operators.skew import SALT, hot_keys
from tallystar.scratch import stage

quick = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_groups_with_copies(spark):
    groups = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n")], "k int, name string")
    measures = spark.createDataFrame([(1, 3, 2.5)], "k int, n bigint, v double")
    kept = keep_groups(groups, measures, "k", ["name"], counts=["n"], sums=["v"])
    assert rows_of(kept) == [(1, "a", 6, 5.0), (2, "b", 0, None), (None, "n", 0, None)]
    distinct = keep_groups(groups, measures, "k", ["name"], distinct_counts=["n"])
    assert rows_of(distinct) == [(1, "a", 3), (2, "b", 0), (None, "n", 0)]
    matched = match_groups(groups, measures, "k", ["name"], counts=["n"])
    assert rows_of(matched) == [(1, "a", 6)]


def test_count_pairs(spark):
    pairs = spark.createDataFrame([(1, 7), (1, 7), (1, 8), (2, None), (3, 9)], "k int, m int")
    assert rows_of(count_pairs(pairs, "k", "m", "n")) == [(1, 2), (3, 1)]
    within = spark.createDataFrame([(7,), (7,), (None,)], "m int")
    assert rows_of(count_pairs(pairs, "k", "m", "n", within)) == [(1, 1)]


def test_roll_up_with_a_hot_link(spark):
    measures = spark.createDataFrame([(7, 2), (8, 5), (9, 1)], "k bigint, n bigint")
    rows = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id % 3 + 7 END AS k", "id % 5 AS p")
    plain = roll_up(measures, [Link(rows, "k", "p")], ["n"])
    assert rows_of(roll_up(measures, [Link(rows, "k", "p", unique=False)], ["n"])) == rows_of(plain)


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x")], "a int, b string")
    assert rows_of(distinct_rows(df)) == [(1, "x"), (1, None)]
    assert rows_of(distinct_rows(df, "a")) == [(1,)]


@pytest.mark.parametrize("join", [anti_join, anti_join_sql])
def test_anti_join(spark, join):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (2, "b")], "id int, v string")
    right = spark.createDataFrame([(1,), (1,), (None,)], "ref int")
    assert rows_of(join(left, right, "id", "ref")) == [(2, "b"), (2, "b"), (None, "n")]
    assert "LeftAnti" in plan_of(join(left, right, "id", "ref"))


def test_top_k_places_nulls_and_ties(spark):
    df = spark.createDataFrame([("a", 2), ("b", None), ("c", 5), ("d", 5)], "k string, v int")
    assert [r["k"] for r in top_k(df, "v", 2, ["k"]).collect()] == ["c", "d"]
    assert [r["k"] for r in top_k(df, "v", 2, ["k"], nulls_first=True).collect()] == ["b", "c"]
    assert [r["k"] for r in top_k(df, "v", 1, ["k"], descending=False).collect()] == ["a"]
    assert "TakeOrderedAndProject" in plan_of(top_k(df, "v", 2, ["k"]))


@quick
@given(
    values=st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=40),
    k=st.integers(1, 5),
    descending=st.booleans(),
)
def test_ranked_with_ties_is_rank(spark, values, k, descending):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    order = F.desc_nulls_last("v") if descending else F.asc_nulls_last("v")
    expected = df.withColumn("rnk", F.rank().over(Window.orderBy(order)).cast("bigint")).where(F.col("rnk") <= k)
    assert rows_of(ranked_with_ties(df, "v", k, descending)) == rows_of(expected)


def test_ranked_with_ties_keeps_ties_out_of_the_window(spark):
    ranked = ranked_with_ties(spark.range(50_000).selectExpr("id", "id % 2 AS v"), "v", 3)
    assert ranked.count() == 25_000
    below_window = plan_of(ranked).split("Window [")[1].splitlines()
    assert "TakeOrderedAndProject(limit=3" in below_window[1]


def test_ranks_beyond_the_broadcast_bound(spark):
    df = spark.range(200_000).selectExpr("id", "id div 2 AS v")
    assert ranked_with_ties(df, "v", 150_000).count() == 150_000
    assert ranked_with_ties(df, "v", 1_000_000).agg({"rnk": "max"}).first()[0] == 199_999


def test_best_per_arm(spark):
    totals = spark.createDataFrame(
        [(1, "x", None, 2, 4.0, 1), (2, "y", 3.0, 1, 4.0, 1), (3, "z", 9.0, 0, None, 0)],
        "k int, name string, a double, a_rows int, b double, b_rows int",
    )
    arms = [Arm("a", "a", "a_rows"), Arm("b", "b", "b_rows")]
    best = best_per_arm(totals, "k", ["name"], arms)
    assert rows_of(best) == [("a", 2, "y", 3.0), ("b", 1, "x", 4.0)]
    only_null = totals.where("k = 1")
    assert rows_of(best_per_arm(only_null, "k", ["name"], arms[:1])) == [("a", 1, "x", None)]


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "b string, a int")
    assert rows_of(union_all(a, b)) == [(1, "x"), (1, "x"), (2, "y")]
    assert rows_of(union_distinct(a, b)) == [(1, "x"), (2, "y")]


def _skewed(spark):
    many = spark.range(3_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS v")
    one = spark.range(3_000).selectExpr("id AS k", "id * 10 AS w")
    return many, union_all(one, one.where("k = 7"))


def test_salted_join_is_the_plain_join(spark):
    many, one = _skewed(spark)
    assert rows_of(salted_join(many, one, "k", parts=16)) == rows_of(many.join(one, "k"))


def test_hot_keys_are_few_and_spread(spark):
    many, one = _skewed(spark)
    assert rows_of(hot_keys(many, "k", 16)) == [(7, 6)]
    pair = salt_pair(many, one, "k", parts=16)
    sizes = [r["count"] for r in pair.many.where("k = 7").groupBy(SALT).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * sum(sizes) / len(sizes)
    again = salt_pair(many, one, "k", parts=16)
    assert rows_of(pair.many) == rows_of(again.many)


def test_identical_rows_get_different_salts(spark):
    copies = spark.range(0, 4_000, 1, 16).selectExpr("CAST(7 AS BIGINT) AS k", "CAST(1 AS BIGINT) AS v")
    pair = salt_pair(copies, spark.range(10).withColumnRenamed("id", "k"), "k", parts=8)
    assert pair.many.groupBy(SALT).count().count() > 1
    assert pair.many.join(pair.one, list(pair.on)).count() == 4_000


def test_lookup_broadcasts_only_within_its_bound(spark):
    many, one = _skewed(spark)
    dimension = stage(one.distinct(), "dimension")
    expected = rows_of(many.join(one.distinct(), "k"))
    small = lookup(many, dimension, "k")
    assert "BroadcastHashJoin" in plan_of(small)
    assert rows_of(small) == expected
    large = lookup(many, dimension, "k", max_rows=100)
    assert SALT in plan_of(large)
    assert rows_of(large) == expected


def test_exchanges_of_distinct_counts_and_anti_joins(spark):
    sf_dir, name = "/root/testdata/sf0.001", "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "-1")
    try:
        for query, most in (("topn_distinct", 4), ("topn_inner", 4), ("anti_join", 2)):
            assert plan_of(REGISTRY[query](spark, sf_dir)).count("Exchange hashpartitioning") <= most
    finally:
        spark.conf.unset(name)


@pytest.mark.parametrize("parts", [1, 3, 50])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_of_every_row(spark, parts, descending):
    values = [5.0, 5.0, None, 1.0, float("nan"), 5.0, -0.0, 0.0, None, 7.5, *[3.0] * 20]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    expected = rows.withColumn("rnk", F.rank().over(Window.orderBy(order)).cast("bigint"))
    found = rank_all(rows, "v", descending, parts=parts)
    assert rows_of(found.select("i", "rnk")) == rows_of(expected.select("i", "rnk"))
    assert rank_all(rows.limit(0), "v").count() == 0


def test_rank_of_every_row_has_no_window_over_all(spark):
    plan = rank_all(spark.range(100).withColumn("v", F.col("id") % 10), "v")._jdf.queryExecution().toString()
    assert "Exchange SinglePartition" not in plan
