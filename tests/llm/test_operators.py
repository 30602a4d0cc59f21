"""The operators against brute-force versions, exact round trips and held-out accuracy, on small tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar.llm import bpe, jaccard, language, packing, quality, secrets, shingles, token_counts, url_rules, vectors, warc
from tallystar.llm.common import prepare
from tallystar.llm.components import components, roots
from tallystar.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_tokens string"
LONG = "word" + "x" * 3000 + " " + "mot " * 4000


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


def docs(spark, texts, langs=None):
    rows = [(i, t, (langs or {}).get(i, "en"), "s", None, "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_texts():
    choice = random.Random(3)
    alphabet = list("ab  \n\t'sdtAé漢🙂\x85\xa0\x1c٣9_-.") + ["<|endoftext|>", " the", "'ll", "  "]
    return [None, "", " ", "\n\n", LONG, "a"] + ["".join(choice.choices(alphabet, k=40)) for _ in range(200)]


# ---- tokens -------------------------------------------------------------------------------------------------


def test_tokens_are_those_of_the_library(session):
    from tokenizers import Tokenizer

    texts = odd_texts()
    library = Tokenizer.from_file(tokenizer_path())
    ids = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    rows = docs(session, texts)
    counted = token_counts.count_tokens(rows, tokenizer_path()).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in counted] == [len(i) for i in ids]
    assert [r["n_bytes"] for r in counted] == [len((t or "").encode()) for t in texts]
    decoded = bpe.decode(bpe.encode(rows, tokenizer_path()), tokenizer_path()).orderBy("doc_id").collect()
    assert [r["ids"] for r in decoded] == ids
    assert [r["decoded"] for r in decoded] == [t or "" for t in texts]
    assert counted[0]["kept"] == "clash"


def test_ids_that_spell_no_text(session):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    ids = [[120, 200], [50256, 5], [], [255, 255, 100]]
    rows = session.createDataFrame([(i,) for i in [*ids, None]], "ids array<int>")
    found = [r["decoded"] for r in bpe.decode(rows, tokenizer_path()).collect()]
    assert found == [*(library.decode(i, skip_special_tokens=False) for i in ids), ""]


# ---- quality ------------------------------------------------------------------------------------------------


def expected_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for starts in windows.values() if len(starts) > 1 for i in starts for k in range(8)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_verdicts(session):
    clean = "the cat and the dog are in a house that is old and it was for this one on a hill by the sea.\n" * 1
    loop = "one two three four five six seven eight nine " * 5
    texts = [*odd_texts(), clean, clean * 3, loop, "#$%& " * 30, "a b c d e f g a b c d e f g a b c", " \x0b x\r\ny \n\n x"]
    rows = quality.judge(docs(session, texts)).orderBy("doc_id").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(r[n] for n in names) for r in rows] == [expected_counts(t) for t in texts]
    by_text = {t: r for t, r in zip(texts, rows, strict=True)}
    assert by_text[clean]["kept"] and not by_text[clean]["base_failed"]
    assert by_text[None]["base_failed"] and by_text[loop]["base_failed"] and not by_text["#$%& " * 30]["kept"]


def test_quality_is_one_projection(session):
    plan = quality.judge(docs(session, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# ---- language -----------------------------------------------------------------------------------------------


def test_language_on_held_out_texts(session):
    made = random.Random(5)
    words = {"en": "the and that was with from have this".split(), "de": "der und das nicht auch eine sich werden".split()}
    texts = [" ".join(made.choices(words[("en", "de")[i % 2]], k=12)) for i in range(200)]
    langs = {i: ("en", "de")[i % 2] for i in range(200)}
    rows = docs(session, [*texts, None, "", "123 !?"], langs)
    filters = language.learn(rows.where(language.learnable(F.col("doc_id"))))
    found = {r["doc_id"]: r for r in language.identify(rows, filters).collect()}
    assert all(found[i]["lang_pred"] == langs[i] for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0)
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (200, 201, 202))
    nothing = language.learn(rows.where("false"))
    assert {r["lang_pred"] for r in language.identify(rows, nothing).collect()} == {"und"}


def test_filter_returns_all_languages_that_contain_a_trigram():
    members = [(g, [f"l{k}" for k in range(70) if g % (k + 2) == 0]) for g in range(1, 500)]
    built = language.Filters.build(members, [f"l{k}" for k in range(70)])
    bits = built.containing(np.arange(1, 500, dtype=np.int64))
    for (_, own), row in zip(members, bits, strict=True):
        assert all(int(row[int(name[1:]) // 64]) >> (int(name[1:]) % 64) & 1 for name in own)


# ---- vectors and components ---------------------------------------------------------------------------------


def test_components_of_paths_and_stars(session):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = components(session.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == roots(links)


def test_vectors_match_brute_force(session, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    made = np.random.default_rng(1)
    base = made.standard_normal((6, 8))
    near = [b + made.standard_normal(8) * 0.06 for b in base for _ in range(30)]
    values = [v.tolist() for v in near] + [near[0].tolist()] * 3
    odd = [None, [0.0] * 8, [float("nan")] * 8, [None] * 8, [1.0] * 7, [float("inf")] + [0.0] * 7]
    rows = [(i, v, i % 2) for i, v in enumerate(values)] + [(900 + i, v, 0) for i, v in enumerate(odd)] + [(990, near[0].tolist(), None)]
    df = session.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: r for r in vectors.near_duplicates(df).collect()}
    links = []
    for (i, a, x), (j, b, y) in itertools.combinations(rows[: len(values)], 2):
        a, b = np.array(a), np.array(b)
        if x == y and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
            links.append((i, j))
    top = roots(links)
    for i, _, _ in rows:
        assert found[i]["n_links"] == sum(i in link for link in links)
        assert found[i]["component_id"] == top.get(i, i) and found[i]["kept"] == (top.get(i, i) == i)


def test_estimates_are_unbiased_and_bounded():
    made = np.random.default_rng(2)
    plan = vectors.Plan.for_count(64, 5000, 0.98)
    x = made.standard_normal((400, 64))
    codes, factors, _ = plan.encode(x)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    spread = np.sqrt(1 - factors**2) / factors / math.sqrt(63)
    bounds = plan.upper_bounds(codes, factors, x)
    error = bounds - vectors.DEVIATIONS * spread[:, None] - unit @ unit.T
    off = ~np.eye(400, dtype=bool)
    assert abs(error[off].mean()) < 0.002 and (bounds >= unit @ unit.T).all()


# ---- Jaccard ------------------------------------------------------------------------------------------------


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) > 4 else frozenset([tuple(words)] if words else [])


def test_jaccard_matches_brute_force(session, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT_LIST", 4)
    monkeypatch.setattr(jaccard, "OPEN_PER_SET", 3)
    made = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)]
    common = " ".join(made.choices(vocabulary, k=60))
    texts = [None, "", " \n", "one", "ONE", "one two", "É", "é", LONG, LONG]
    for _ in range(6):
        base = made.choices(vocabulary, k=made.randint(40, 120))
        for _ in range(12):
            copy = list(base)
            for _ in range(made.randint(0, 4)):
                copy[made.randrange(len(copy))] = made.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [common + " " + " ".join(made.choices(vocabulary, k=made.randint(5, 200))) for _ in range(40)]
    sets = [shingle_set(t) for t in texts]
    links = [
        (i, j)
        for i, j in itertools.combinations(range(len(sets)), 2)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    top = roots(links)
    found = {r["doc_id"]: r for r in jaccard.near_duplicates(docs(session, texts)).collect()}
    assert len(links) > 100
    for i, s in enumerate(sets):
        assert (found[i]["n_shingles"], found[i]["component_id"]) == (len(s), top.get(i, i))
    assert jaccard.near_duplicates(docs(session, texts).where("false")).count() == 0


def test_bitmaps_never_claim_too_much():
    made = np.random.default_rng(4)
    for _ in range(50):
        a, b = (np.unique(made.integers(0, 2**63, made.integers(1, 400), dtype=np.uint64)) for _ in range(2))
        b = np.unique(np.append(b, a[: len(a) // 2]))
        true = len(np.setxor1d(a, b))
        assert jaccard.least_difference(jaccard.bitmap(a), jaccard.bitmap(b)) <= true
        assert jaccard.Bitmaps([jaccard.bitmap(a), jaccard.bitmap(b)]).least_differences(0, np.array([1]))[0] <= true


def test_shingles_do_not_depend_on_the_batch():
    texts = [t.encode() for t in ("a b c d e f", "", "x", "A B c d e f", LONG)]
    together = shingles.shingle_sets(texts)
    assert all((x == shingles.shingle_sets([t])[0]).all() for x, t in zip(together, texts, strict=True))
    assert (together[0] == together[3]).all() and len(together[1]) == 0


# ---- URLs and archives --------------------------------------------------------------------------------------


def test_url_rules(session):
    urls = {
        "http://a.Example.COM/de/1": ("a.example.com", "/de/1", "com/", "allow"),
        "http://a.example.com/en/1?x=1": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/#t": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://b.net/fr/": ("b.net", "/fr/", "net/fr/", "block"),
        "http://bnet/frx/": ("bnet", "/frx/", None, "allow"),
        "http://x.com?q": ("x.com", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u) for i, u in enumerate(urls)] + [(50 + i, f"http://s{i}.net/fr/{i}") for i in range(60)]
    rows.append((200, "http://s3.net/fr"))  # no listed rule fits; the mined one does
    found = {r["page_id"]: r for r in url_rules.judge(session.createDataFrame(rows, "page_id long, url string")).collect()}
    for (i, _), want in zip(rows, urls.values(), strict=False):
        assert tuple(found[i][c] for c in ("host", "path", "rule", "verdict")) == want
    assert found[200]["rule"] is None and found[200]["verdict"] == "block" and "path:fr" in found[200]["mined"]
    assert url_rules.judge(session.createDataFrame([], "page_id long, url string")).count() == 0


def test_archives_round_trip(session):
    page = "<p>" + "x" * 200
    rows = [(3, "http://b.a/1", page), (1, "http://b.a/1", page), (2, None, "short"), (4, "http://a.b/\r\nx", "short")]
    rows += [(5, "http://c/", None), (6, "http://c/", "é\r\n\r\nWARC/1.1\r\n" * 30), (6, "http://c/", "é\r\n\r\nWARC/1.1\r\n" * 30)]
    pages = session.createDataFrame(rows, "page_id long, url string, html string")
    archive = warc.build_index(warc.write_archives(pages))
    found = [r.asDict() for r in warc.read_urls(archive, pages.select("url")).collect()]
    assert sorted(r["page_id"] for r in found) == sorted(str(r[0]) for r in rows)
    for r in found:
        html = next(h or "" for i, _, h in rows if str(i) == r["page_id"]).encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(html), hashlib.sha256(html).hexdigest())
        assert r["refers_to"] == ("1" if r["page_id"] == "3" else None)
        assert bytes(r["payload"]) == html if r["record_type"] == "response" else r["payload"] is None
    assert {r["page_id"] for r in warc.lookup(archive, "http://b.a/1")} == {"1", "3"}
    assert warc.lookup(archive, "http://nowhere/") == []
    empty = warc.build_index(warc.write_archives(pages.where("false")))
    assert warc.read_urls(empty, pages.select("url")).count() == 0


def test_archive_search_past_the_directory_bound(session, monkeypatch):
    pages = session.createDataFrame([(i, f"http://h/{i % 7}", "x") for i in range(40)], "page_id long, url string, html string")
    archive = warc.build_index(warc.write_archives(pages))
    urls = session.createDataFrame([("http://h/3",), ("http://h/9",)], "url string")
    near = warc.search(archive, urls).count()
    monkeypatch.setattr(warc, "BROADCAST_BYTES", 0)
    assert near == warc.search(archive, urls).count() == 6


# ---- packing and secrets ------------------------------------------------------------------------------------


def test_bounds_are_optimal():
    made = random.Random(2)
    for _ in range(40):
        histogram = {n: made.randint(1, 9) for n in made.sample(range(1, 30), made.randint(1, 8))}
        buckets = made.randint(1, 4)

        def padding(bounds, own=histogram):
            return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in own.items())

        inner = [n for n in histogram if n != max(histogram)]
        options = [(*c, max(histogram)) for k in range(min(buckets, len(histogram))) for c in itertools.combinations(inner, k)]
        bounds = packing.optimal_bounds(histogram, buckets)
        assert len(bounds) <= buckets and padding(bounds) == min(map(padding, options))


def test_batches_hold_every_token_once(session, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 8)
    rows = docs(session, ["w " * n for n in (0, 1, 3, 3, 3, 7, 50, 50, 123)] + [None] + ["w " * 5] * 40)
    packed = packing.pack(rows, packing.words(F.col("text")), max_length=50, buckets=3, budget=100).collect()
    assert sum(r["length"] for r in packed) == 1 + 9 + 7 + 100 + 123 + 200
    assert {r["doc_id"] for r in packed} == set(range(50))
    batches = {}
    for r in packed:
        assert (r["batch_id"] is None) == (r["length"] == 0) and r["padding"] == r["bucket_length"] - r["length"]
        batches.setdefault(r["batch_id"], []).append(r["bucket_length"])
    assert all(sum(own) <= 100 and len(set(own)) == 1 for own in batches.values())
    assert packing.pack(rows.where("false"), F.length("text")).count() == 0


def test_secrets_are_found_and_words_are_not(session):
    made = random.Random(9)
    prose = lambda k: " ".join(made.choices("the house stands near river and meadow beside forest".split(), k=k))
    key = lambda: "AKIA" + "".join(made.choices("ABCDEFGHJKLMNPQRSTUVWXYZ234567", k=16))
    hexed = lambda: "".join(made.choices("0123456789abcdef", k=40))
    texts = [f"{prose(9)} {key()} {prose(9)}" for _ in range(40)] + [f'{prose(9)} token = "{hexed()}" {prose(5)}' for _ in range(40)]
    texts += [f"{prose(9)} password: meadow {prose(5)}" for _ in range(40)] + [prose(30)] * 5 + [None, "", LONG]
    rows = docs(session, texts)
    scanner = secrets.scanner(rows)
    found = secrets.find(rows, scanner).where("secret").collect()
    assert {r["doc_id"] for r in found} == set(range(80))
    clean = {r["doc_id"]: r for r in secrets.redact(rows, scanner).collect()}
    assert all(r["value"] not in clean[r["doc_id"]]["text"] for r in found)
    assert all(clean[i]["text"] == texts[i] for i in range(80, len(texts)))
    assert secrets.find(rows.where("false"), secrets.scanner(rows.where("false"))).count() == 0


def test_dictionary_counts_every_word_whatever_the_partitions(session, monkeypatch):
    monkeypatch.setattr(secrets, "DICTIONARY", 5)
    texts = ["rare often"] * 3 + ["often twice"] * 2 + [f"often filler{i} filler{i}" for i in range(6)] + [None, ""]
    rows = docs(session, texts)
    hashes = lambda *own: frozenset(shingles.words([w.encode() for w in own])[0].tolist())
    # 11 often, 3 rare, then seven words twice: of equal counts the smallest keys, as signed numbers
    tied = hashes("twice", *(f"filler{i}" for i in range(6)))
    tied = sorted(tied, key=lambda h: h - (1 << 64) if h >> 63 else h)[:3]
    for n in (1, 3, 8):
        assert secrets.profile(rows.repartition(n)).dictionary == hashes("often", "rare") | set(tied)
    monkeypatch.setattr(secrets, "DICTIONARY", 100)
    assert len(secrets.profile(rows.repartition(8)).dictionary) == 9


def test_long_lists_are_split_into_cells(session, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL_ROWS", 8)
    answers = {1: [7] * 100 + [8] * 30 + list(range(20, 40)), 2: [9] * 50, 3: [1, 2, 2]}
    rows = [(k, 1000 * k + i, a) for k, own in answers.items() for i, a in enumerate(own)]
    cells = {}
    for r in jaccard._in_cells(session.createDataFrame(rows, "list long, doc long, answer long")).collect():
        cells.setdefault((r["list"], r["low"], r["high"]), []).append((r["doc"], r["answer"], r["part"]))
    met = []
    for (number, low, high), own in cells.items():
        assert len(own) <= 40 < len(answers[1])
        for x, y in itertools.combinations(own, 2):
            if x[1] != y[1] and (x[2] != y[2] or low == high):
                met.append((number, *sorted((x[0], y[0]))))
    pairs = [(k, x, y) for (k, x, a), (m, y, b) in itertools.combinations(rows, 2) if k == m and a != b]
    assert sorted(met) == sorted(pairs)


def test_jaccard_in_cells_matches_brute_force(session, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL_ROWS", 5)
    made = random.Random(13)
    vocabulary = [f"w{i}" for i in range(300)]
    first, second = (made.choices(vocabulary, k=60) for _ in range(2))
    texts = []
    for base, n in ((first, 60), (second, 40)):
        for _ in range(n):
            copy = list(base)
            for _ in range(made.randint(0, 3)):
                copy[made.randrange(len(copy))] = made.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [" ".join(first[:20] + made.choices(vocabulary, k=30)) for _ in range(40)]
    sets = [shingle_set(t) for t in texts]
    links = [(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2) if 100 * len(a & b) >= 75 * len(a | b)]
    top = roots(links)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs(session, texts)).collect()}
    assert found == {i: top.get(i, i) for i in range(len(texts))}
