"""Alignment of two tokenizers against a brute-force version, on small tables."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as contract
from tallystar.llm import alignment
from tallystar.llm.common import prepare
from tallystar.llm.queries import OTHER_TOKENIZER, tokenizer_path
from tallystar.scratch import stage

DOCS = "doc_id long, text string, n_a string, links string, kept string"
PATHS = tokenizer_path(), tokenizer_path(OTHER_TOKENIZER)


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


def library_tokens(text):
    """(id, start, end) of both sides, by the libraries on the whole text; None where they do not spell it."""
    pair = alignment.load(*PATHS)
    if not text:
        return None
    ids = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    sides = []
    for own, spelled in zip(ids, (pair.bytes_a, pair.bytes_b), strict=True):
        if b"".join(spelled[i] for i in own) != (" " + text).encode():
            return None
        ends = np.cumsum([len(spelled[i]) for i in own]).tolist()
        sides.append(list(zip(own, [0, *ends], ends, strict=False)))
    return sides


def brute(a, b):
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, low = [], 0
    for cut in cuts:
        groups.append(([i for i, _, e in a if low < e <= cut], [i for i, _, e in b if low < e <= cut]))
        low = cut
    links = []
    first = 0
    for i, s, e in a:
        while b[first][2] <= s:
            first += 1
        k = first
        while k < len(b) and b[k][1] < e:
            links.append((i, b[k][0]))
            k += 1
    return groups, links


def expected(texts):
    sides = [library_tokens(t) for t in texts]
    solved = [brute(*s) if s else ([], []) for s in sides]
    held = Counter(p for _, links in solved for p in set(links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    rows = []
    for side, (groups, links) in zip(sides, solved, strict=True):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sha = hashlib.sha256(shown.encode()).hexdigest() if side else ""
        n_a, n_b = (len(side[0]), len(side[1])) if side else (0, 0)
        n_best = sum(held[p] == best[p[0]] for p in links)
        rows.append((n_a, n_b, len(groups), len(links), n_best, sum(held[p] for p in links), sha))
    return rows


def odd_texts():
    made = random.Random(8)
    alphabet = [*"ab \n\t\r'sdtAé漢🙂\x85\xa0\x1c٣9_-.}{;▁", "<|endoftext|>", "<s>", " the", "'ll", "  ", "}\r\n", "   ", "\x00"]
    long = "the river " * 3000 + "  " + "x" * 3000 + " mot" * 2000
    texts = [None, "", " ", "\n\n", "a", " a ", "a▁b", "▁", "\t", long, "<0x0A>", "a\r\n b"]
    texts += ["".join(made.choices(alphabet, k=made.choice([3, 40]))) for _ in range(250)]
    return texts + ["the house is old"] * 5 + ["".join(made.choices(alphabet[:-9], k=60)) for _ in range(100)]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def found(session, texts, **limits):
    docs = session.createDataFrame([(i, t, "clash", "clash", "k") for i, t in enumerate(texts)], DOCS)
    aligned = stage(alignment.align(docs, *PATHS), "aligned")
    rows = alignment.score_links(aligned, "doc_id", **limits).orderBy("doc_id").collect()
    assert all(r["kept"] == "k" for r in rows)
    sha = [hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] is not None else "" for r in rows]
    return [(*(r[n] for n in NAMES), s) for r, s in zip(rows, sha, strict=True)]


def test_alignment_equals_brute_force(session):
    texts = odd_texts()
    rows = expected(texts)
    assert sum(r[0] == 0 for r in rows) < len(rows) // 2
    assert found(session, texts) == rows


def test_small_parts_and_a_shuffled_join_find_the_same(session, monkeypatch):
    texts = odd_texts()
    monkeypatch.setattr(alignment, "PART_BYTES", 300)
    monkeypatch.setattr(alignment, "MEMO_TOKENS", 100)
    aligner = alignment.Aligner(*PATHS)
    small = aligner.align(texts)
    monkeypatch.undo()
    whole = aligner.align(texts)
    assert all(small[n].equals(whole[n]) for n in whole)
    assert found(session, texts, broadcast_pairs=1) == expected(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), min_size=1, max_size=60), st.integers(1, 9))
def test_pieces_of_any_size_give_the_same_merge(cuts, piece):
    """Each position may be an end of either side; the last is one of both."""
    cuts = [*cuts, (True, True)]
    a = np.array([i + 1 for i, (x, _) in enumerate(cuts) if x])
    b = np.array([i + 1 for i, (_, y) in enumerate(cuts) if y])
    got = alignment.merge(a, b, piece)
    starts_a, starts_b = np.append(0, a[:-1]), np.append(0, b[:-1])
    overlaps = {(i, j) for i in range(len(a)) for j in range(len(b)) if max(starts_a[i], starts_b[j]) < min(a[i], b[j])}
    assert set(zip(got.left.tolist(), got.right.tolist(), strict=True)) == overlaps and len(got.left) == len(overlaps)
    both = np.intersect1d(a, b)
    assert got.group_of_a.tolist() == np.searchsorted(both, a).tolist()
    assert got.group_of_b.tolist() == np.searchsorted(both, b).tolist()


def test_diagonals_cut_the_merge_into_equal_pieces():
    made = np.random.default_rng(3)
    a, b = (np.unique(np.append(made.integers(1, 10_000, n), 10_000)) for n in (50, 3000))
    diagonals = np.arange(0, len(a) + len(b) + 1)
    merged = sorted([(e, 0) for e in a.tolist()] + [(e, 1) for e in b.tolist()])
    counts = np.append(0, np.cumsum([side == 0 for _, side in merged]))
    assert alignment.diagonal_cuts(a, b, diagonals).tolist() == counts.tolist()


def test_empty_table(session):
    assert found(session, []) == []


def test_query_on_the_given_tables(session):
    folder = "/root/testdata/sf0.001"
    docs = session.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    rows = contract.queries()["op11_alignment"](session, folder).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == [d["doc_id"] for d in docs]
    assert [(*(r[n] for n in NAMES), r["groups_sha256"]) for r in rows] == expected([d["text"] for d in docs])
