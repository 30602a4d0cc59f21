"""Importance resampling against a brute-force version, on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest

import __spark_entry__ as contract
from tallystar.llm import resample
from tallystar.llm.common import prepare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, weight string, rank string, kept string"


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


def features(text):
    words = WORD.findall((text or "").translate(UPPER))
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def expected(docs, target):
    """Rows (id, features, weight, score, words) and the ids in the order of their ranks."""
    found = [features(t) for _, t in docs]
    s, t = [0] * 10000, [0] * 10000
    for _, own in found:
        for b in own:
            s[b] += 1
    for text in target:
        for b in features(text)[1]:
            t[b] += 1
    gains = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10000) / ((a + 1) * (sum(t) + 10000)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for (doc, _), (n, own) in zip(docs, found, strict=True):
        weight = sum(gains[b] for b in own)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((-r[3], math.inf if r[0] is None else r[0]) for r in rows if r[4] >= 20)
    return rows, able[: len(able) * 5 // 100]


def check(rows, docs, target):
    plain, ranks = expected(docs, target)
    names = ("doc_id", "n_features", "weight", "score", "n_words")
    assert sorted((tuple(r[n] for n in names) for r in rows), key=repr) == sorted(plain, key=repr)
    drawn = sorted((r["rank"], r["score"], r["doc_id"]) for r in rows if r["rank"] is not None)
    assert [r for r, _, _ in drawn] == list(range(1, len(ranks) + 1))
    assert [(-s, math.inf if i is None else i) for _, s, i in drawn] == ranks


def frames(session, docs, target):
    rows = session.createDataFrame([(i, t, "clash", "clash", "k") for i, t in docs], DOCS)
    return rows, session.createDataFrame([(t,) for t in target], "text string")


def cases():
    made = random.Random(6)
    alphabet = ["a", "B", "c1", "é", "É", "the", "of", "x" * 30]
    texts = [None, "", " .,", "word " * 19, "one", "the of " * 9000, "A-b " * 30]
    texts += [" ".join(made.choices(alphabet, k=made.choice([3, 20, 60]))) for _ in range(400)]
    docs = list(enumerate(texts))
    docs += [(500, texts[30])] * 40 + [(None, texts[31])] * 3 + [(501, texts[32]), (501, texts[33])]
    return docs, [*texts[20:25], None, ""]


def test_scores_and_ranks_equal_brute_force(session):
    docs, target = cases()
    out = resample.resample(*frames(session, docs, target))
    assert set(out.columns) == {"doc_id", "kept", "n_words", "n_features", "weight", "score", "rank"}
    check(out.collect(), docs, target)


def test_ties_beyond_the_threshold(session):
    docs = [(7, "the of " * 15)] * 100 + [(i, "the of " * 15) for i in range(20)]
    rows, target = frames(session, docs, ["of the"])
    check(resample.resample(rows, target).collect(), docs, ["of the"])


def test_parts_of_a_long_text(session, monkeypatch):
    docs, target = cases()
    text = " , ".join(t for _, t in docs[7:60])
    whole = features(text)[1]
    for size in (1, 7, 100):
        monkeypatch.setattr(resample, "PART_BYTES", size)
        parts = [b for ends in resample.runs_of(text.encode(), 10000) for e in ends for b in e.tolist()]
        assert sorted(parts) == sorted(whole)


def test_least_reaching(session):
    made = random.Random(2)
    values = [made.choice([-5, 0, 3, 10**12, made.randrange(-(10**6), 10**6)]) for _ in range(500)]
    rows = session.createDataFrame([(v,) for v in values], "v long")
    for wanted in (1, 2, 100, 250, 499, 500):
        cut, below = resample.least_reaching(rows, "v", wanted)
        assert cut == sorted(values)[wanted - 1] and below == sum(v < cut for v in values)


def test_empty_tables(session):
    assert resample.resample(*frames(session, [], ["a b"])).count() == 0
    check(resample.resample(*frames(session, [(1, "a b " * 20), (2, None)], [])).collect(), [(1, "a b " * 20), (2, None)], [])


def test_query_on_the_given_tables(session):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in session.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in session.read.parquet(f"{folder}/benchmark.parquet").collect()]
    check(contract.queries()["op13_resample"](session, folder).collect(), docs, target)
