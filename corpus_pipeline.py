"""The training-data pipeline over ``documents``: stages that each write their rows for the next one to read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm import jaccard, language, packing, quality, secrets
from tallystar.llm.common import prepare, table
from tallystar.llm.queries import tokenizer_path
from tallystar.scratch import stage

BROADCAST_KEYS = 1 << 21  # keys of copies that go to all tasks, 16 MB

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents to whose text a language can be given; null texts, texts without a letter and, where nothing could be
    learnt, all others go."""
    prepare(spark)
    filters = language.learn(docs.where(language.learnable(F.col("doc_id"))))
    found = language.identify(docs, filters)
    return found.where(F.col("lang_pred") != language.UNKNOWN).select(docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base check and the threshold table."""
    prepare(spark)
    return docs.where(quality.verdict(F.col("text"))["kept"])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, and of those that share it any one.

    Decided row by row, so rows that share an id stay or go by their own texts. A document without an id stays only if
    its group has none with one.
    """
    prepare(spark)
    rows, by_id = jaccard.with_keys(docs, "doc_id")
    found = stage(jaccard.classes(rows, "__key", "text"), "classes")
    if by_id:
        copies = stage(found.where("key <> component").select("key"), "copies")
    else:
        ids = rows.select("__key", F.col("doc_id").cast("long").alias("id"))
        members = found.join(ids, F.col("key") == F.col("__key")).select("key", "component", "id")
        first = F.min(F.struct(F.col("id").isNull(), "id", "key"))["key"].alias("stays")
        stays = members.groupBy("component").agg(first)
        copies = stage(members.join(stays, "component").where("key <> stays").select("key"), "copies")
    if copies.count() <= BROADCAST_KEYS:  # counted in file footers; else the texts are shuffled
        copies = F.broadcast(copies)
    return rows.join(copies, F.col("__key") == F.col("key"), "left_anti").select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark; the number of characters follows the text."""
    prepare(spark)
    clean = secrets.redact(docs, secrets.scanner(docs))
    changed = F.col("n_secrets") > 0
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of all documents in batches, with lengths in tokens."""
    prepare(spark)
    return packing.pack_tokens(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("quality", good_quality),
    ("near copies", one_of_each),
    ("secrets", without_secrets),
    ("packing", packed),
]
ORACLE_SQL = None  # training, similarity joins and packing are not SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order. Each result is written to the shared folder and read again for the next stage."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
