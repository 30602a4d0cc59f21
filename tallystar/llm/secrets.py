"""Secret scanning: candidates from patterns, false positives removed by a random forest.

1. One pass over the corpus counts which character follows which, and all its words; the most frequent are the dictionary.
2. Patterns find candidates: keys with a known prefix, values assigned to a telling name, long mixed strings.
3. A candidate's features are its length, its mean character transition, entropy, the share of digits, the share that
   dictionary words cover, whether it stands in a path, URL or address, and what words and signs stand beside it.
4. The forest is trained by Spark on labelled findings, then applied in the same pass that finds the candidates, so
   texts are neither shuffled nor joined.

Findings of the corpus are labelled by what can be told from their form (``form_label``), others have none. The same places with a
word of the text as value are added as labelled false positives. Training takes a sample of at most
``TRAIN_FINDINGS`` labelled findings, chosen by hash; the counts of step 1 and the scan cover every text.

Defined results: a null or empty text has no findings. If the findings to learn from are all of one kind, no forest is
trained, and the form alone decides. Rows are scanned one by one, whole; equal rows give equal findings. An empty table gives
none. ``redact`` keeps all input columns but one of the name that it adds; ``find`` gives the id and what it found.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.llm.common import replacing, texts, with_columns
from tallystar.llm.shingles import words
from tallystar.scratch import stage

TRAIN_FINDINGS = 20_000
DICTIONARY = 1 << 16  # most frequent words
DICTIONARY_ROWS = 1 << 20  # words that a task counts at once before it sends their counts
TREES, DEPTH, SEED = 20, 5, 7
SECRET = 0.5  # votes from which a finding is a secret
MASK = "[SECRET]"

NAMES = r"pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth(?:orization)?|credential|private[_-]?key"
PATTERNS = re.compile(
    r"(?P<access_key>(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9]))"
    r"|(?P<prefixed>(?<![A-Za-z0-9])(?:gh[pousr]_|sk-|xox[abprs]-|AIza|glpat-)[A-Za-z0-9_\-]{16,})"
    r"|(?P<web_token>eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]+)"
    r"|(?P<key_block>-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*-----END [A-Z ]*PRIVATE KEY-----)"
    rf"|(?i:\b(?:{NAMES}))[\"']?[ \t]*(?:=>|:=|[:=])[ \t]*[\"']?(?P<assigned>[^\s\"'<>]{{6,}})"
    r"|(?P<mixed>(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*\d)(?=[\d+/_\-]*[A-Za-z])[A-Za-z0-9+/_\-]{16,}={0,2})"
)
KINDS = ("access_key", "prefixed", "web_token", "key_block", "assigned", "mixed")
TELLING = re.compile(NAMES, re.IGNORECASE)
RUNS = re.compile(r"[A-Za-z]{2,}")
WORD = re.compile(r"\S+")
HEX = re.compile(r"[0-9a-fA-F]+")


def candidates(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and kind of each candidate."""
    for found in PATTERNS.finditer(text):
        kind = found.lastgroup
        yield *found.span(kind), kind


def form_label(kind: str, value: str) -> int | None:
    """1 for a form that only keys have, 0 for a value that is plain words, None where the form doesn't tell."""
    digits = sum(c.isdigit() for c in value)
    if kind in ("access_key", "prefixed", "web_token", "key_block"):
        return 1 if digits or kind == "key_block" else None
    if kind == "assigned" and len(value) >= 16 and digits >= 4 and HEX.fullmatch(value):
        return 1
    return 0 if digits == 0 or digits == len(value) else None


# ---- what the corpus is like --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Profile:
    transitions: np.ndarray  # log probability of each byte after each
    dictionary: frozenset[int]  # hashes of frequent words

    def knows(self, runs: list[str]) -> list[bool]:
        if not runs:
            return []
        hashes, _ = words([r.encode() for r in runs])
        return [h in self.dictionary for h in hashes.tolist()]

    def features(self, text: str, start: int, end: int, kind: str) -> list[float]:
        value = text[start:end]
        raw = np.frombuffer(value.encode(), dtype=np.uint8)
        counts = Counter(value)
        runs = RUNS.findall(value)
        covered = sum(len(r) for r, known in zip(runs, self.knows(runs), strict=True) if known)
        before, after = text[max(0, start - 60) : start], text[end : end + 60]
        near = [w.strip(".,;:!?\"'()") for w in WORD.findall(before)[-3:] + WORD.findall(after)[:2]]
        near = [w for w in near if RUNS.fullmatch(w)]
        return [
            float(len(value)),
            float(self.transitions[raw[:-1], raw[1:]].mean()) if len(raw) > 1 else 0.0,
            -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values()),
            sum(c.isdigit() for c in value) / len(value),
            sum(c.isupper() for c in value) / len(value),
            covered / len(value),
            max((len(r) for r in runs), default=0) / len(value),
            float("/" in value or "\\" in value or before[-1:] in "/\\." and before != ""),
            float("://" in before[-40:].rpartition(" ")[2] + value),
            float("@" in value or before[-1:] == "@" or after[:1] == "@"),
            float(bool(TELLING.search(before[-24:]))),
            float(before.rstrip(" \t\"'")[-1:] in ("=", ":")),
            float(before[-1:] in ("'", '"') and after[:1] == before[-1:]),
            sum(self.knows(near)) / max(1, len(near)),
            float(bool(HEX.fullmatch(value))),
            float(KINDS.index(kind)),
        ]


def profile(df: DataFrame, text: str = "text") -> Profile:
    """Transitions and dictionary of all texts. The driver gets 65,536 counts and at most ``DICTIONARY`` words."""

    def rows(kind: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        kinds = pa.array(np.full(len(key), kind, dtype=np.int32))
        return pa.RecordBatch.from_pydict({"kind": kinds, "key": pa.array(key), "n": pa.array(n.astype(np.int64))})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(1 << 16, dtype=np.int64)
        held: list[np.ndarray] = []
        for batch in batches:
            whole = [(t or "").encode() for t in texts(batch, "text")]
            raw = np.frombuffer(b" ".join(whole), dtype=np.uint8).astype(np.uint16)
            if len(raw) > 1:
                pairs += np.bincount(raw[:-1] << 8 | raw[1:], minlength=1 << 16)
            held.append(words(whole)[0])
            if sum(map(len, held)) >= DICTIONARY_ROWS:
                yield counts(held)
                held = []
        yield counts(held)
        yield rows(0, np.arange(1 << 16), pairs)

    def counts(held: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *held]), return_counts=True)
        return rows(1, found.view(np.int64), n)

    counted = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(work, "kind int, key long, n long")
    counted = stage(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "profile")
    pairs = np.ones((256, 256))
    for row in counted.where("kind = 0 and n > 0").collect():
        pairs[divmod(row["key"], 256)] += row["n"]
    dictionary = most_frequent(counted.where("kind = 1").select("key", "n"), DICTIONARY).view(np.uint64).tolist()
    return Profile(np.log(pairs / pairs.sum(axis=1, keepdims=True)), frozenset(dictionary))


def most_frequent(counted: DataFrame, limit: int) -> np.ndarray:
    """Keys of the ``limit`` largest counts, of equal counts the smallest keys. Where the limit falls is found by counts
    per count and per range of keys, so no task sorts the top of all partitions."""
    sizes = counted.groupBy("n").count().orderBy(F.desc("n")).collect()  # distinct counts are few
    left, least = limit, None
    for row in sizes:
        if row["count"] > left:
            least = row["n"]
            break
        left -= row["count"]
    if least is None:
        return np.asarray(counted.select("key").toArrow()["key"]).astype(np.int64)
    ties = counted.where(F.col("n") == least).withColumn("range", F.shiftright("key", 48))
    last, within = None, 0
    for row in ties.groupBy("range").count().orderBy("range").collect():  # at most 65,536 ranges
        last, within = row["range"], within + row["count"]
        if within >= left:
            break
    above = np.asarray(counted.where(F.col("n") > least).select("key").toArrow()["key"]).astype(np.int64)
    tied = np.sort(np.asarray(ties.where(F.col("range") <= last).select("key").toArrow()["key"]).astype(np.int64))
    return np.append(above, tied[:left])


# ---- forest -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """Trees as nested tuples: (feature, threshold, left, right), or the share of secrets in a leaf."""

    trees: list

    @classmethod
    def of(cls, model: RandomForestClassificationModel) -> Forest:
        def node(java) -> tuple | float:
            if java.subtreeDepth() == 0:
                stats = list(java.impurityStats().stats())
                return stats[1] / sum(stats) if len(stats) > 1 else 0.0
            split = java.split()
            return split.featureIndex(), split.threshold(), node(java.leftChild()), node(java.rightChild())

        return cls([node(tree._java_obj.rootNode()) for tree in model.trees])

    def score(self, features: list[float]) -> float:
        total = 0.0
        for tree in self.trees:
            while isinstance(tree, tuple):
                feature, threshold, left, right = tree
                tree = left if features[feature] <= threshold else right
            total += tree
        return total / len(self.trees)


@dataclass(frozen=True)
class Scanner:
    profile: Profile
    forest: Forest | None

    def scan(self, text: str | None) -> list[tuple[int, int, str, float]]:
        """Start, end, kind and score of each finding."""
        found = []
        for start, end, kind in candidates(text or ""):
            if self.forest:
                score = self.forest.score(self.profile.features(text, start, end, kind))
            else:
                score = float(form_label(kind, text[start:end]) or 0)
            found.append((start, end, kind, score))
        return found


def labelled(df: DataFrame, known: Profile, text: str = "text") -> DataFrame:
    """Columns ``label`` and ``features``: the findings of the corpus that their form labels."""
    shared = df.sparkSession.sparkContext.broadcast(known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for whole in texts(batch, "text"):
                for start, end, kind in candidates(whole or ""):
                    label = form_label(kind, whole[start:end])
                    if label is not None:
                        rows.append((label, shared.value.features(whole, start, end, kind)))
                    if kind == "assigned":  # the same place with the words beside it as value: no secret
                        word = max(RUNS.findall(whole[max(0, start - 200) : end + 200]), key=len, default="")
                        if len(word) >= 6:
                            made = whole[:start] + word + whole[end : end + 200]
                            rows.append((0, shared.value.features(made, start, start + len(word), kind)))
            labels, features = [r[0] for r in rows], [r[1] for r in rows]
            yield pa.RecordBatch.from_pydict(
                {"label": pa.array(labels, pa.int32()), "features": pa.array(features, pa.list_(pa.float64()))}
            )

    return df.select(F.col(f"`{text}`").alias("text")).mapInArrow(work, "label int, features array<double>")


def train(findings: DataFrame, limit: int = TRAIN_FINDINGS) -> Forest | None:
    """A forest from labelled findings; None if they are not of both kinds. Each kind gives at most half of ``limit``."""
    findings = stage(findings, "labelled-findings")
    if findings.select("label").distinct().count() < 2:
        return None
    by_hash = [F.xxhash64("label", "features"), F.col("label")]
    parts = [findings.where(F.col("label") == k).orderBy(*by_hash).limit(limit // 2) for k in (0, 1)]
    sample = stage(parts[0].union(parts[1]).coalesce(1), "training")
    rows = sample.select(F.col("label").cast("double").alias("label"), array_to_vector("features").alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return Forest.of(forest.fit(rows))


def scanner(df: DataFrame, text: str = "text") -> Scanner:
    """A scanner made for the texts of ``df``."""
    known = profile(df, text)
    return Scanner(known, train(labelled(df, known, text)))


# ---- use ----------------------------------------------------------------------------------------------------


def find(df: DataFrame, made: Scanner, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """One row per finding: the id, ``start``, ``end``, ``kind``, ``value``, ``score``, ``secret``."""
    shared = df.sparkSession.sparkContext.broadcast(made)
    rows = df.select(F.col(f"`{row_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    added = "start int, end int, kind string, value string, score double, secret boolean"
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL(added)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at = [], []
            for i, whole in enumerate(texts(batch, "text")):
                for start, end, kind, score in shared.value.scan(whole):
                    rows.append((start, end, kind, whole[start:end], score, score >= SECRET))
                    at.append(i)
            columns = [list(c) for c in zip(*rows, strict=True)] or [[]] * 6
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.bool_()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            ids = batch.column(0).take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([ids, *arrays], schema.names)

    return rows.mapInArrow(work, schema).withColumnRenamed("id", row_id)


def redact(df: DataFrame, made: Scanner, text: str = "text") -> DataFrame:
    """``df`` with each secret replaced by ``MASK``, and ``n_secrets``."""
    shared = df.sparkSession.sparkContext.broadcast(made)
    rows = df.select(*replacing(df, "n_secrets"))
    schema = T.StructType([*rows.schema, T.StructField("n_secrets", T.LongType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, counts = [], []
            for whole in texts(batch, text):
                spans = [(s, e) for s, e, _, score in shared.value.scan(whole) if score >= SECRET]
                for start, end in reversed(spans):
                    whole = whole[:start] + MASK + whole[end:]
                clean.append(whole)
                counts.append(len(spans))
            yield with_columns(batch, **{text: pa.array(clean, pa.string())}, n_secrets=pa.array(counts, pa.int64())).select(
                schema.names
            )

    return rows.mapInArrow(work, schema)
