"""Every registered query against DuckDB on the given tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tallystar.plans.bindings import REGISTRY
from tallystar.plans.oracle import ORACLE_SQL

SF_DIR = os.environ.get("TALLYSTAR_SF_DIR", "/root/testdata/sf0.001")

# Names as the catalog of Spark and of DuckDB write them.
TYPES = {
    "tinyint": "TINYINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _canonical(rows):
    return sorted((tuple(row) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLE_SQL)
    assert set(REGISTRY) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    expected = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    types = {d[0]: str(d[1]) for d in expected.description}
    assert sorted(df.columns) == sorted(names)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    expected_rows = _canonical(expected.fetchall())
    assert _canonical(df.select(*names).collect()) == expected_rows


def test_entry(spark):
    assert contract.entry(spark).count() == 10
