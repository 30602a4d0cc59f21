"""Rows that share an id, or have none: each is judged by its own text."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallystar.llm import bpe, jaccard, packing, token_counts, vocabulary
from tallystar.llm.common import prepare
from tallystar.llm.components import roots
from tallystar.llm.queries import tokenizer_path
from tests.llm.test_operators import odd_texts, shingle_set

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


def texts_of(seed, n):
    made = random.Random(seed)
    return [" ".join(made.choices([f"w{i}" for i in range(500)], k=60)) for _ in range(n)]


def frame(session, rows):
    return session.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)


def shared_ids():
    a, b, c, d = texts_of(1, 4)
    return [(1, a), (5, a + " tail"), (5, b), (None, c), (None, c + " end"), (9, c), (None, d), (None, d), (None, None), (7, "")]


def test_a_text_without_copy_stays_whatever_its_id(session):
    rows = shared_ids()
    kept = corpus_pipeline.one_of_each(session, frame(session, rows), "").collect()
    found = sorted(((r["doc_id"], r["text"]) for r in kept), key=repr)
    assert found == sorted([rows[0], rows[2], rows[5], rows[6], rows[8], rows[9]], key=repr)


def test_classes_of_rows_that_share_ids(session):
    made = random.Random(3)
    rows = shared_ids() + [(made.choice([1, 2, 3, None]), t) for t in texts_of(4, 5) for _ in range(4)]
    sets = [shingle_set(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) > 0]
    top = roots(pairs)
    members = {}
    for i in range(len(rows)):
        members.setdefault(top.get(i, i), []).append(rows[i][0])
    least = {k: min((x for x in own if x is not None), default=None) for k, own in members.items()}
    expected = [(rows[i][0], len(sets[i]), least[top.get(i, i)]) for i in range(len(rows))]
    found = jaccard.near_duplicates(frame(session, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_rows_without_ids_are_spread_over_shards(session, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 100)
    rows = session.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("a b").alias("text"))
    packed = packing.pack(rows, packing.words(F.col("text")), max_length=50, buckets=3, budget=100)
    shards = packed.groupBy(F.split("batch_id", "-")[1]).count().collect()
    assert len(shards) == 30 and max(r["count"] for r in shards) < 200


def test_lengths_are_those_of_the_library(session):
    library = Tokenizer.from_file(tokenizer_path())
    texts = [*odd_texts(), "x" * 50_000, "<|endoftext|>" * 3]
    rows = session.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    found = packing.token_lengths(rows, tokenizer_path()).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in found] == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert packing.token_lengths(rows.where("false"), tokenizer_path()).count() == 0


def test_memo_forgets_long_keys_and_stays_bounded(monkeypatch):
    monkeypatch.setattr(vocabulary, "MEMO_BYTES", 5000)
    texts = [t for t in odd_texts() if t] + ["y" * 1000 + str(i) for i in range(50)]
    encoder, counter = bpe.Encoder(tokenizer_path()), token_counts.Counter(tokenizer_path())
    library = Tokenizer.from_file(tokenizer_path())
    for at in range(0, len(texts), 20):
        some = texts[at : at + 20]
        ids = [library.encode(t, add_special_tokens=False).ids for t in some]
        assert encoder.encode(some).to_pylist() == ids and counter.count(some) == [len(i) for i in ids]
    encoder.encode(["short"])
    assert not any(len(k) > vocabulary.LONG_KEY for k in encoder.memo.known) and len(encoder.memo.known) < 200
