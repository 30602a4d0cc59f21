"""SQL for the queries that it can express, for DuckDB over the same tables."""

from __future__ import annotations

from tallystar.llm.quality import STOP_WORDS, THRESHOLDS, Threshold


def _holds(rule: Threshold) -> str:
    checks = []
    if rule.at_least is not None:
        checks.append(f"{rule.measure} * 1000 >= {rule.base} * {rule.at_least}")
    if rule.at_most is not None:
        checks.append(f"{rule.measure} * 1000 <= {rule.base} * {rule.at_most}")
    return " AND ".join(checks)


QUALITY = f"""
WITH parts AS (
    SELECT doc_id, coalesce(text, '') AS whole,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, unnest(range(len(words) - 7)) AS i, words FROM parts WHERE len(words) >= 8
), spelled AS (
    SELECT doc_id, i, array_to_string(words[i + 1:i + 8], ' ') AS w FROM windows
), repeated AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM spelled) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM repeated) GROUP BY doc_id
), counted AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(whole, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
        len(list_filter(words, lambda x: x IN ({", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))})))::BIGINT AS n_stop_words,
        length(regexp_replace(whole, '\\P{{Lu}}+', '', 'g'))::BIGINT AS n_upper
    FROM parts LEFT JOIN covered USING (doc_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND {" AND ".join(_holds(t) for t in THRESHOLDS)} AS kept
FROM counted
"""

WARC = """
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM firsts
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

DECONTAMINATE = f"""
WITH items AS (
    SELECT item_id, {_WORDS} AS w, least(10, len(w)) AS k FROM benchmark
), wanted AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i + 1:i + k], ' ') AS passage
    FROM (SELECT item_id, w, k, unnest(range(len(w) - k + 1)) AS i FROM items WHERE k > 0)
), texts AS (
    SELECT doc_id, {_WORDS} AS w FROM documents
), placed AS (
    SELECT doc_id, k, i, array_to_string(w[i + 1:i + k], ' ') AS passage
    FROM (SELECT doc_id, w, k, unnest(range(greatest(len(w) - k + 1, 0))) AS i FROM texts, (SELECT DISTINCT k FROM wanted))
), hits AS (
    SELECT doc_id, item_id, i, k FROM placed JOIN wanted USING (k, passage)
), words AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM hits) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM texts LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {"op8_quality": QUALITY, "op9_warc": WARC, "op12_decontaminate": DECONTAMINATE}
