"""The dealt operators bound to the given tables: one query each, over the whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm import (
    alignment,
    bpe,
    decontaminate,
    jaccard,
    language,
    packing,
    quality,
    resample,
    secrets,
    token_counts,
    url_rules,
    vectors,
    warc,
)
from tallystar.llm.common import prepare, table
from tallystar.scratch import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZER = "byte_bpe_50k.json"
OTHER_TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 1024


def register(query: Query) -> Query:
    QUERIES[query.__name__] = lambda spark, sf_dir: query(prepare(spark), sf_dir)
    return query


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the public vocabulary file is; the package that holds it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text that they decode to, as digests."""
    path = tokenizer_path()
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    decoded = bpe.decode(ids, path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the threshold table on every text."""
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*first, "n_lines", "n_stop_words", "n_upper")


@register
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text, and whether they are more than a context holds."""
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@register
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learnt from four fifths of the documents."""
    docs = table(spark, sf_dir, "documents")
    filters = language.learn(docs.where(language.learnable(F.col("doc_id"))))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    found = language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), filters)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@register
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back through the capture index of their urls."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archive = warc.build_index(warc.write_archives(pages))
    records = warc.read_urls(archive, pages.select("url"))
    return records.select(
        F.col("page_id").cast("long"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long"),
    )


@register
def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    judged = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined")


@register
def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every embedding."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


@register
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of every document and the class of those that overlap by three quarters."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of all documents, with lengths in tokens."""
    return packing.pack_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


@register
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of every document, with the forest's verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.find(docs, secrets.scanner(docs)).drop("value")


@register
def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every text that lie in a passage of a benchmark item."""
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontaminate.decontaminate(docs, items)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    found = found.withColumn("n_hit", n_hit)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document towards the benchmark, and the rank of those drawn."""
    docs, target = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    return resample.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank", "n_words")


@register
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers for every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = alignment.align(docs, tokenizer_path(), tokenizer_path(OTHER_TOKENIZER))
    digest = F.coalesce(F.sha2("groups", 256), F.lit("")).alias("groups_sha256")
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    rows = aligned.select("doc_id", *numbers, digest, "links", F.monotonically_increasing_id().alias("row"))
    scored = alignment.score_links(stage(rows, "aligned"), "row")
    return scored.select("doc_id", *numbers, "n_best", "count_sum", "groups_sha256")
