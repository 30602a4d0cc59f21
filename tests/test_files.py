from __future__ import annotations

import datetime as dt
import glob
import json
import os
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.scratch import fresh_dir, shared_root, stage
from tallystar.sinks import write_csv, write_dated, write_parquet, write_run_date
from tallystar.sources import (
    Evolution,
    infer_types,
    read_csv,
    read_csv_inferred,
    read_evolved,
    read_feed_dates,
    read_feed_day_before,
    read_json,
    read_json_inferred,
    read_json_merged,
    read_run_date,
)
from tests.test_operators import plan_of, rows_of

quick = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
FEED = T.StructType().add("product_id", "integer").add("date", "date")
DAY = dt.date(2021, 1, 2)

texts = st.one_of(
    st.none(),
    st.sampled_from(["", " ", '"', '""', "a,b", 'a "q" b', "x\ny", "x\r\ny", "\n", "\r", "\\", '\\"', "'", " pad ", "null", "#c", "\0", "\0\0", "\0a"]),
    st.text(st.characters(exclude_categories=["Cs", "Cc"]), max_size=12),
)


@quick
@given(values=st.lists(st.tuples(texts, texts), min_size=1, max_size=30), columns=st.integers(1, 3))
def test_csv_keeps_any_text(spark, values, columns):
    rows = [(a, b, i)[:columns] for i, (a, b) in enumerate(values)]
    df = spark.createDataFrame(rows, ", ".join(("a string", "b string", "id int")[:columns]))
    path = f"{fresh_dir(spark, 'csv')}/t"
    write_csv(df, path)
    assert rows_of(read_csv(spark, path, df.schema)) == rows_of(df)
    assert read_csv_inferred(spark, path).count() == len(rows)


def test_csv_of_one_number(spark):
    df = spark.createDataFrame([(None,), (1,), (None,)], "n int")
    path = f"{fresh_dir(spark, 'csv')}/t"
    write_csv(df, path)
    assert rows_of(read_csv(spark, path, df.schema, keep_corrupt=True).select("n", "_corrupt_record")) == rows_of(
        df.selectExpr("n", "CAST(NULL AS STRING)")
    )
    assert rows_of(read_csv_inferred(spark, path)) == rows_of(df)


def test_csv_quoted_empty_number_is_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text('n,d,s\n"",2021-01-02,""\n1,"",\n"x","",y\n')
    schema = T.StructType().add("n", "integer").add("d", "date").add("s", "string")
    rows = rows_of(read_csv(spark, str(tmp_path), schema, keep_corrupt=True))
    assert rows == sorted([(None, DAY, "", None), (1, None, None, None), (None, None, "y", '"x","",y')], key=repr)
    (tmp_path / "inferred").mkdir()
    (tmp_path / "inferred" / "t.csv").write_text('n,s\n"",a\n1,""\n,b\n')
    inferred = read_csv_inferred(spark, str(tmp_path / "inferred"))
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "string"]
    assert rows_of(inferred) == sorted([(None, "a"), (1, ""), (None, "b")], key=repr)


def test_csv_as_the_database_writes_it(spark, tmp_path):
    (tmp_path / "t.csv").write_text('client_id,fullname,location_area_id\n1,"a,b ""q""\nz",5\n2,"",\n3,,7\n')
    schema = T.StructType().add("client_id", "integer").add("fullname", "string").add("location_area_id", "integer")
    rows = rows_of(read_csv(spark, str(tmp_path), schema))
    assert rows == [(1, 'a,b "q"\nz', 5), (2, "", None), (3, None, 7)]


def test_csv_header_in_another_order_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path), T.StructType().add("a", "integer").add("b", "integer")).collect()


def test_csv_keeps_what_does_not_parse(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,d\n1,2021-01-02\nx,2021-13-45\n")
    rows = rows_of(read_csv(spark, str(tmp_path), T.StructType().add("a", "integer").add("d", "date"), keep_corrupt=True))
    assert rows == [(1, DAY, None), (None, None, "x,2021-13-45")]


def test_csv_files_are_bounded(spark):
    path = f"{fresh_dir(spark, 'csv')}/t"
    sizes = [128 << 10, 5, 128 << 10, 300 << 10, 0] * 8
    rows = [(i, '"' * 50 + "x" * n if n else None) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "id int, text string").coalesce(2)
    write_csv(df, path, max_bytes=256 << 10)
    written = {f: os.path.getsize(f) for f in glob.glob(f"{path}/*/*.csv")}
    over = [f for f, size in written.items() if size > 256 << 10]
    assert len(over) == 8 and all(len(open(f, newline="").read().splitlines()) == 2 for f in over)  # one large row each
    assert len(written) < 30
    assert rows_of(read_csv(spark, path, df.schema)) == rows_of(df)
    write_csv(df.limit(3), path)
    assert read_csv_inferred(spark, path).count() == 3 and read_csv_inferred(spark, path).columns == ["id", "text"]


def test_csv_of_no_rows(spark):
    path = f"{fresh_dir(spark, 'csv')}/t"
    df = spark.createDataFrame([], "id int, text string")
    for _ in range(2):
        write_csv(df, path)
        assert read_csv(spark, path, df.schema).count() == 0
        assert read_csv_inferred(spark, path).columns == ["id", "text"]


def test_csv_inferred_in_one_pass(spark):
    values = {
        "small": ["1", "-7", None, ""],
        "large": ["1", "3000000000", None, None],
        "huge": ["9" * 30, "1", "-2", None],
        "real": ["1", "2.5", "-1e3", "NaN"],
        "day": ["2021-01-02", None, "2020-02-29", ""],
        "wrong_day": ["2021-01-02", "2021-02-30", None, None],
        "moment": ["2021-01-02", "2021-01-02 10:11:12.5", "2021-01-02T01:02:03", None],
        "flag": ["true", "FALSE", None, None],
        "padded": [" 1", "2", None, None],
        "suffix": ["1d", "2", None, None],
        "mixed": ["1", "true", None, None],
        "nothing": [None, "", None, None],
    }
    rows = spark.createDataFrame(list(zip(*values.values(), strict=True)), ", ".join(f"{n} string" for n in values))
    kinds = ["INT", "BIGINT", "DECIMAL(38,0)", "DOUBLE", "DATE", "STRING", "TIMESTAMP_NTZ", "BOOLEAN"] + ["STRING"] * 4
    assert infer_types(rows) == dict(zip(values, kinds, strict=True))
    plan = plan_of(rows.agg(F.bool_and(F.col("small").try_cast("int").isNotNull())))
    assert "Python" not in plan
    path = f"{fresh_dir(spark, 'csv')}/t"
    write_csv(rows, path)
    back = read_csv_inferred(spark, path)
    assert [f.dataType.simpleString() for f in back.schema] == [k.lower() for k in kinds]
    assert rows_of(back.select("small", "day", "padded")) == sorted(
        [(1, DAY, " 1"), (-7, None, "2"), (None, dt.date(2020, 2, 29), None), (None, None, None)], key=repr
    )


def test_json_with_different_fields(spark, tmp_path):
    lines = {
        "date=2021-01-01": ['{"a": 1, "deep": {"x": 1.5}}', "not json", "[1]"],
        "date=2021-01-02": ['{"a": "one", "b": [1, 2]}', '{"deep": {"x": 2, "y": true}, "n": null}', ""],
        "date=2021-01-03": ["{}"],
    }
    for folder, own in lines.items():
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "f.json").write_text("\n".join(own) + "\n")
    df = read_json_merged(spark, str(tmp_path), keep_corrupt=True)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    assert kinds == {
        "a": "string", "b": "array<bigint>", "deep": "struct<x:double,y:boolean>", "n": "string",
        "_corrupt_record": "string", "date": "date",
    }
    rows = [(r["a"], r["b"], r["deep"] and tuple(r["deep"]), r["_corrupt_record"], r["date"].day) for r in df.collect()]
    assert sorted(rows, key=repr) == sorted(
        [
            ("1", None, (1.5, None), None, 1), (None, None, None, "not json", 1), (None, None, None, "[1]", 1),
            ("one", [1, 2], None, None, 2), (None, None, (2.0, True), None, 2), (None, None, None, "", 2),
            (None, None, None, None, 3),
        ],
        key=repr,
    )
    assert read_json_merged(spark, str(tmp_path / "date=2021-01-03")).columns == []


def test_columns_that_change_between_dates(spark):
    root = fresh_dir(spark, "evolved")
    days = [DAY + dt.timedelta(days=n) for n in range(3)]
    frames = [
        spark.createDataFrame([(1, "a"), (None, None)], "k int, old string"),
        spark.createDataFrame([("b", 2)], "name string, k bigint"),
        spark.createDataFrame([("c", 3, 9, "x")], "name string, k bigint, extra int, note string"),
    ]
    for day, df in zip(days, frames, strict=True):
        write_run_date(df, root, day, "parquet")
    schema = T.StructType().add("k", "long").add("name", "string").add("extra", "integer")
    rule = Evolution(schema, added={"extra": 0}, widened={"k": ["int"]}, renamed={"name": ["old"]}, dropped=["note"])
    df = read_evolved(spark, root, rule, days)
    expected = [(1, "a", 0, days[0]), (None, None, 0, days[0]), (2, "b", 0, days[1]), (3, "c", 9, days[2])]
    assert rows_of(df) == sorted(expected, key=repr)
    assert "GreaterThan(k,2)" in plan_of(df.where("k > 2").select("k"))
    for wrong, message in (
        (replace(rule, added={}), "extra is missing"),
        (replace(rule, widened={}), "k is int"),
        (replace(rule, dropped=()), "not declared: note"),
        (replace(rule, renamed={}), "name is missing"),
    ):
        with pytest.raises(ValueError, match=message):
            read_evolved(spark, root, wrong, days)


def test_csv_inferred_types(spark):
    df = spark.createDataFrame([(1, 2.5, "x", DAY), (2, 3.0, "", None)], "i int, f double, s string, d date")
    path = f"{fresh_dir(spark, 'csv')}/t"
    write_csv(df, path)
    back = read_csv_inferred(spark, path)
    assert [f.dataType.simpleString() for f in back.schema] == ["int", "double", "string", "date"]
    assert rows_of(back) == rows_of(df)


def test_json_array_document(spark, tmp_path):
    payload = [{"product_id": 1, "date": "2021-01-02"}, {"product_id": 2, "date": "2021-01-02"}]
    (tmp_path / "out_of_stock.json").write_text(json.dumps(payload))
    assert rows_of(read_json(spark, str(tmp_path), FEED)) == [(1, DAY), (2, DAY)]
    assert rows_of(read_json_inferred(spark, str(tmp_path))) == [("2021-01-02", 1), ("2021-01-02", 2)]


def test_json_over_several_lines(spark, tmp_path):
    (tmp_path / "feed.json").write_text(json.dumps([{"product_id": 1, "date": "2021-01-02"}], indent=1))
    assert rows_of(read_json(spark, str(tmp_path), FEED, whole_files=True)) == [(1, DAY)]
    lines = read_json(spark, str(tmp_path), FEED, keep_corrupt=True)
    assert lines.where("product_id is null and _corrupt_record is null").isEmpty() and not lines.isEmpty()


def test_json_without_the_fields_is_a_row_of_nulls(spark, tmp_path):
    (tmp_path / "out_of_stock.json").write_text(json.dumps({"message": "no data"}))
    assert rows_of(read_json(spark, str(tmp_path), FEED)) == [(None, None)]


def _feed(spark, root):
    rows = [(i, DAY + dt.timedelta(days=i % 4)) for i in range(40)] + [(99, None)]
    df = spark.createDataFrame(rows, FEED)
    write_dated(df, root, "json", ["date"])
    return df


def test_feed_by_dates(spark):
    root = f"{fresh_dir(spark, 'feed')}/f"
    df = _feed(spark, root)
    assert rows_of(read_json(spark, root, FEED)) == rows_of(df)
    days = [DAY, DAY + dt.timedelta(days=2), dt.date(1999, 1, 1)]
    some = read_feed_dates(spark, root, FEED, days, allow_missing=True)
    assert rows_of(some) == rows_of(df.where(F.col("date").isin(days)))
    for wanted in (days, days[2:]):
        with pytest.raises(FileNotFoundError, match="1999-01-01"):
            read_feed_dates(spark, root, FEED, wanted)
    with pytest.raises(FileNotFoundError, match="1998-12-31"):
        read_feed_day_before(spark, root, FEED, dt.date(1999, 1, 1))


def test_feed_of_the_day_before_is_pruned(spark):
    root = f"{fresh_dir(spark, 'feed')}/f"
    df = _feed(spark, root)
    before = read_feed_day_before(spark, root, FEED, DAY + dt.timedelta(days=1))
    assert rows_of(before) == rows_of(df.where(F.col("date") == F.lit(DAY)))
    assert all(f"date={DAY.isoformat()}/" in file for file in before.inputFiles())


def test_rewriting_a_date_replaces_only_that_date(spark):
    root = f"{fresh_dir(spark, 'feed')}/f"
    df = _feed(spark, root)
    fewer = df.where(F.col("date") == F.lit(DAY)).where("product_id > 10")
    for _ in range(2):
        write_dated(fewer, root, "json", ["date"])
    kept = df.where(F.col("date").isNull() | (F.col("date") != F.lit(DAY)) | (F.col("product_id") > 10))
    assert rows_of(read_json(spark, root, FEED)) == rows_of(kept)


def test_one_file_per_date(spark):
    root = f"{fresh_dir(spark, 'feed')}/f"
    df = spark.range(0, 4_000, 1, 8).selectExpr("id", "date_add(date'2021-01-01', CAST(id % 3 AS INT)) AS date")
    write_dated(df, root, "parquet", ["date"])
    assert [len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{root}/date=*")] == [1, 1, 1]


def test_run_dates(spark):
    root = fresh_dir(spark, "silver")
    write_run_date(spark.range(5), root, DAY, "parquet")
    write_run_date(spark.range(3), root, DAY + dt.timedelta(days=1), "parquet")
    one = read_run_date(spark, root, DAY)
    assert one.count() == 5
    assert all(f"run_date={DAY.isoformat()}/" in file for file in one.inputFiles())
    write_run_date(spark.range(0), root, DAY, "parquet")
    assert read_run_date(spark, root, DAY).count() == 0
    assert read_run_date(spark, root, DAY + dt.timedelta(days=1)).count() == 3


def test_write_once(spark):
    path = f"{fresh_dir(spark, 'silver')}/t"
    write_parquet(spark.range(5), path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_parquet(spark.range(5), path)
    write_parquet(spark.range(6), path, replace=True)
    assert spark.read.parquet(path).count() == 6


def test_scratch_is_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == named
    before = len(os.listdir(named)) if os.path.exists(named) else 0
    assert stage(spark.range(5), "numbers").count() == 5
    assert len(os.listdir(named)) == before + 1


def test_scratch_needs_a_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        applicationId = "app"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())
