"""Mined URL rules against an enumeration of all token sets, and on templates of many tokens."""

from __future__ import annotations

import itertools
import math
import random
import time

import pytest

from tallystar.llm import url_rules
from tallystar.llm.common import prepare

URLS = "tokens array<string>, label string"


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


def best_by_enumeration(rows, support, confidence):
    """The deciding rule of each distinct token set, from all sets of tokens that occur."""
    held, labelled = {}, {}
    for tokens, label in rows:
        for k in range(1, len(tokens) + 1):
            for own in itertools.combinations(sorted(tokens), k):
                held[own] = held.get(own, 0) + 1
                if label:
                    labelled[own, label] = labelled.get((own, label), 0) + 1
    rules = [
        (n / held[own], n / len(rows), label, list(own))
        for (own, label), n in labelled.items()
        if n >= math.ceil(support * len(rows)) and n / held[own] >= confidence
    ]
    found = {}
    for tokens in {tuple(sorted(t)) for t, _ in rows}:
        fitting = [r for r in rules if set(r[3]) <= set(tokens)]
        if fitting:
            found[tokens] = max(fitting)
    return found


@pytest.mark.parametrize("seed", range(4))
def test_rules_equal_enumeration(session, seed):
    made = random.Random(seed)
    rows = []
    for _ in range(60):
        tokens = {t for t in "abcdef" if made.random() < 0.4}
        if "a" in tokens:
            tokens |= {"k1", "k2", "k3"}  # always together
        bad = {"b", "c"} <= tokens or ("a" in tokens and made.random() < 0.8)
        rows.append((sorted(tokens), made.choice(["block" if bad else "allow", None])))
    urls = session.createDataFrame(rows, URLS)
    found = url_rules.match(urls, url_rules.mine(urls, 0.05, 0.7)).collect()
    expected = best_by_enumeration(rows, 0.05, 0.7)
    # A shorter rule that is no less confident takes a longer one's place; what it says must be the same.
    assert {tuple(r["tokens"]): r["label"] for r in found} == {t: r[2] for t, r in expected.items()}


def test_templates_of_many_keys_end(session):
    keys = [f"key{i}" for i in range(20)]
    query = "&".join(f"{k}=1" for k in keys)
    urls = [(i, f"http://s{i}.net/fr/{i}?{query}") for i in range(100)] + [(100 + i, f"http://t{i}.com/{i}") for i in range(100)]
    urls += [(300, f"http://u.org/x?{query}"), (301, "http://u.org/x")]
    start = time.monotonic()
    found = {r["page_id"]: r for r in url_rules.judge(session.createDataFrame(urls, "page_id long, url string")).collect()}
    assert time.monotonic() - start < 60
    assert found[300]["rule"] is None and found[300]["verdict"] == "block" and found[300]["mined"]
    assert found[301]["verdict"] == "allow" and not found[301]["mined"]


def test_clashing_columns_and_tables_without_tokens(session):
    rows = session.createDataFrame([(1, "nothing", "h", "v"), (2, None, "h", "v")], "page_id long, url string, host string, verdict string")
    out = url_rules.judge(rows)
    assert [c for c in out.columns if c == "host"] == ["host"]
    assert {(r["host"], r["verdict"]) for r in out.collect()} == {("", "allow")}
