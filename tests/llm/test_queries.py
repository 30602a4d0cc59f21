"""Registered queries of the subpackage against SQL where there is some, else their shape on the given tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
from tallystar.llm import packing
from tallystar.llm.oracle import ORACLE_SQL
from tallystar.llm.queries import QUERIES, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    expected = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in expected.description]
    found = contract.queries()[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(names)
    rows = sorted((tuple(r) for r in found.select(*names).collect()), key=repr)
    assert rows == sorted(expected.fetchall(), key=repr)


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in contract.queries()


def test_packing_measures_in_tokens(spark, tmp_path):
    import corpus_pipeline

    texts = ["x" * 9000, "the house, near-by: 1234567890!", "the and that " * 3000, "", None]
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(tokenizer_path())
    expected = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    for packed in (QUERIES["op1_packing"](spark, str(tmp_path)), corpus_pipeline.packed(spark, docs, str(tmp_path))):
        found, batches = [0] * len(texts), {}
        for r in packed.collect():
            found[r["doc_id"]] += r["length"]
            assert r["length"] <= packing.MAX_LENGTH
            if r["batch_id"] is not None:
                batches[r["batch_id"]] = batches.get(r["batch_id"], 0) + r["bucket_length"]
        assert found == expected and all(size <= packing.BUDGET for size in batches.values())
