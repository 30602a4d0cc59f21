"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

The windows of all benchmark items (``WINDOW`` consecutive words; a shorter item is one window) are sets of word
shingles. Every shingle of a window must occur in a text that holds the window, so the prefix that is necessary for
containment is one shingle. One pass over the texts counts how often each benchmark shingle occurs; a window with a
shingle that never does is out, and of the others the rarest shingle is the prefix. A second pass joins the positions of
the texts with the prefixes, bounds the window by the shingle's offset and the length of the text, and compares all words
of the window at that place.

Windows travel to the texts, never the other way: a block of windows of at most ``BLOCK_BYTES`` is broadcast, and a larger
benchmark goes against all texts in several blocks. Only verified places are shuffled, by row.

Defined results: a text that is null, empty or without a word has no spans and no items. Items that are null or without a
word have no window, a null item id marks words but is no item. Rows with equal ids are judged one by one, items with
equal ids are one item. A text of any length is one row, whose positions stream through the join. Empty tables give no
rows, or rows without spans. Input columns of the names that are added give way to them.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystar.llm.common import replacing
from tallystar.scratch import stage

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 16 << 20
# Fixed value: what stands between words once A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text: Column) -> Column:
    """The words of a text, with A-Z (and nothing else) in lower case; none of a null text."""
    whole = F.coalesce(text, F.lit(""))
    only_ascii = F.octet_length(whole) == F.char_length(whole)
    translated = F.translate(whole, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(F.when(only_ascii, F.lower(whole)).otherwise(translated), SEPARATORS), "")


def item_windows(items: DataFrame, item_id: str, text: str, width: int) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (``window``, ``words``, ``width``, ``bytes``), and the items that hold each."""
    rows = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), word_array(F.col(f"`{text}`")).alias("all"))
    rows = rows.where(F.size("all") > 0).withColumn("width", F.least(F.lit(width), F.size("all")))
    rows = rows.select("item", "all", "width", F.explode(F.expr("sequence(0, size(all) - width)")).alias("start"))
    rows = stage(rows.select("item", F.expr("slice(all, start + 1, width)").alias("words")).distinct(), "item-windows")
    numbered = rows.select("words").distinct().withColumn("window", F.monotonically_increasing_id())
    size = F.octet_length(F.concat_ws(" ", "words")).cast("long") + 64
    numbered = numbered.select("window", "words", F.size("words").alias("width"), size.alias("bytes"))
    windows = stage(numbered, "windows")
    held = rows.where("item is not null").join(windows.select("words", "window"), "words").select("window", "item")
    return windows, stage(held, "window-items")


def shingles_of(windows: DataFrame, size: int) -> DataFrame:
    """The shingles of each window, by hash, with their offset in it."""
    at = F.explode(F.expr(f"sequence(0, width - {size})")).alias("offset")
    rows = windows.select("window", "words", at)
    return rows.select("window", "offset", _hash(size, F.col("offset")).alias("shingle"))


def _hash(size: int, at: Column) -> Column:
    return F.xxhash64(*(F.get("words", at + i) for i in range(size)))


def _positions(rows: DataFrame, size: int, first: int) -> DataFrame:
    """One row per word of each text, with the hash of the shingle that starts there, and with ``first`` -1 one without
    shingle before them."""
    numbers = F.when(F.col("n_words") > first, F.sequence(F.lit(first), F.col("n_words") - 1))
    placed = rows.select("*", F.explode(numbers).alias("at"))
    return placed.withColumn("shingle", F.when(F.col("at") >= 0, _hash(size, F.col("at"))))


def _blocks(rows: DataFrame, key: str, size: Column) -> list[DataFrame]:
    """``rows`` in parts of about ``BLOCK_BYTES``, each with whole keys."""
    n = max(-(-(rows.agg(F.sum(size)).first()[0] or 0) // BLOCK_BYTES), 1)
    return [rows if n == 1 else rows.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def prefixes(rows: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """Of each window that can occur, the rarest shingle over all ``rows`` and its offset."""
    placed = stage(shingles_of(windows, size), "shingles")
    counts = []
    for block in _blocks(placed.select("shingle").distinct(), "shingle", F.lit(16)):
        found = _positions(rows, size, first=0).join(F.broadcast(block), "shingle")
        counts.append(found.groupBy("shingle").agg(F.count("*").alias("n")))
    known = placed.join(reduce(DataFrame.union, counts), "shingle", "left")
    rarest = F.min_by(F.struct("offset", "shingle"), F.struct("n", "shingle", "offset")).alias("rarest")
    ranked = known.groupBy("window").agg(rarest, F.count("n").alias("seen"), F.count("*").alias("needed"))
    return stage(ranked.where("seen = needed").select("window", "rarest.*"), "prefixes")


def _places(rows: DataFrame, block: DataFrame, size: int, first: int) -> DataFrame:
    """Where the windows of a block occur in the rows. From -1 on there is also one place without window for each row."""
    candidates = F.broadcast(block.withColumnRenamed("words", "wanted"))
    start = F.col("at") - F.col("offset")
    inside = (start >= 0) & (start + F.col("width") <= F.col("n_words"))
    same = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("width")) == F.col("wanted")
    placed = _positions(rows, size, first)
    joined = placed.join(candidates, (placed["shingle"] == candidates["shingle"]) & inside & same, "left")
    joined = joined.where((F.col("at") < 0) | F.col("window").isNotNull())
    others = [c for c in rows.columns if c != "words"]
    return joined.select(*others, "at", start.alias("start"), (start + F.col("width")).alias("end"), "window")


def _spans(places: DataFrame) -> DataFrame:
    """The union of the places of each row as spans that do not overlap or touch, in order."""
    ends = places.groupBy("row", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("row").orderBy("start")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    fresh = ends.withColumn("fresh", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    spans = fresh.withColumn("span", F.sum("fresh").over(before)).groupBy("row", "span")
    spans = spans.agg(F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"))
    return spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def decontaminate(
    df: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
) -> DataFrame:
    """``df`` without the text, with ``n_words``, the merged ``spans`` of words that lie in a window of an item (``start``
    and ``end``, from 0, the end excluded) and the distinct ``items`` whose windows occur, in the order of their ids as
    text."""
    others = replacing(df.drop(text), "n_words", "spans", "items")
    rows = df.select(F.struct(*others).alias("kept"), word_array(F.col(f"`{text}`")).alias("words"))
    rows = rows.withColumn("n_words", F.size("words")).withColumn("row", F.monotonically_increasing_id())
    windows, held = item_windows(items, item_id, item_text, width)
    shingle_size = F.least("width", F.lit(SHINGLE))
    sizes = [r[0] for r in windows.select(shingle_size).distinct().collect()] or [SHINGLE]  # at most SHINGLE sizes
    blocks = []
    for size in sizes:
        chosen = windows.where(shingle_size == size)
        wanted = chosen.join(prefixes(rows, chosen, size), "window")
        blocks += [(block.drop("bytes"), size) for block in _blocks(wanted, "window", F.col("bytes"))]
    if len(blocks) > 1:  # a row must have the same number in every pass
        rows = stage(rows, "words")
    found = [_places(rows, block, size, -1 if i == 0 else 0) for i, (block, size) in enumerate(blocks)]
    found = stage(reduce(DataFrame.union, found), "places")
    hits = found.where("window is not null").select("row", "start", "end", "window")
    named = hits.select("row", "window").distinct().join(held, "window")
    named = named.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = found.where("at < 0").join(_spans(hits), "row", "left").join(named, "row", "left")
    return out.select(
        "kept.*",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
