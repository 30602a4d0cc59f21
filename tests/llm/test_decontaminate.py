"""Benchmark decontamination against brute force, on small tables."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tallystar.llm import decontaminate
from tallystar.llm.common import prepare

DOCS = "doc_id long, text string, spans string, row long, kept string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def expected(texts, items, width=10):
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(width, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(item)
    found = []
    for text in texts:
        own, hit, named = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    named |= windows[tuple(own[i : i + size])]
        found.append((len(own), len(hit), sorted(str(n) for n in named if n is not None)))
    return found


def run(session, texts, items):
    docs = session.createDataFrame([(i, t, "clash", 5, "k") for i, t in enumerate(texts)], DOCS)
    bench = session.createDataFrame(items, "item_id long, text string")
    out = decontaminate.decontaminate(docs, bench)
    rows = out.orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    assert all(r["row"] == 5 and r["kept"] == "k" for r in rows)
    for r in rows:
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))
    return [(r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) for r in rows]


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


def cases():
    made = random.Random(4)
    alphabet = ["a", "B", "c1", "é", "É", "the", "x" * 40]
    items = [(i, " ".join(made.choices(alphabet, k=made.choice([1, 2, 3, 9, 10, 11, 30])))) for i in range(3, 25)]
    items += [(1, None), (2, ""), (None, "null id of five words"), (3, items[0][1]), (30, items[5][1]), (31, "--- !")]
    long = "filler words " * 5000 + items[7][1] + " end " * 3000
    texts = [None, "", "  .,", long, "the null id, of FIVE words", items[9][1].upper() + ". " + items[9][1]]
    texts += [", ".join(made.choices(alphabet, k=60)) for _ in range(60)] + [items[7][1]] * 3
    return texts, items


def test_windows_equal_brute_force(session):
    texts, items = cases()
    assert run(session, texts, items) == expected(texts, items)


def test_several_blocks_find_the_same(session, monkeypatch):
    texts, items = cases()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    assert run(session, texts, items) == expected(texts, items)


def test_empty_tables(session):
    assert run(session, [], [(1, "a b")]) == []
    assert run(session, ["a b c", None], []) == [(3, 0, []), (0, 0, [])]


def test_prefix_is_the_rarest_shingle(session):
    docs = session.createDataFrame([("a b c d " * 5 + "x b c d y",)], "text string")
    rows = docs.select(decontaminate.word_array(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    items = session.createDataFrame([(1, "x b c d"), (2, "b c d never")], "item_id long, text string")
    windows, _ = decontaminate.item_windows(items, "item_id", "text", 10)
    found = decontaminate.prefixes(rows, windows, 3).join(windows, "window").collect()
    assert [(r["words"], r["offset"]) for r in found] == [(["x", "b", "c", "d"], 0)]


def test_no_python_in_the_plan(session):
    docs = session.createDataFrame([(1, "a b c")], "doc_id long, text string")
    out = decontaminate.decontaminate(docs, session.createDataFrame([(1, "a b")], "item_id long, text string"))
    assert "Python" not in out._jdf.queryExecution().toString()
