"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Every measure is a built-in column expression over one row, so the plan is a scan, projections and nothing else:
no exchange, no Python. Ratios are compared as products of whole numbers, so no rounding decides a verdict.

Words are runs without blank, tab, line feed, vertical tab, form feed and carriage return. Defined results: a null or
empty text has no words, all its counts are 0 and its base check fails. Repeated rows are judged one by one. Input
columns of the names that ``judge`` adds give way to them; any other column is kept. A text of any length is one row, judged
whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import replacing

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that for it was on are as with be at by this from or an not have "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont "
    "de la que el en y a los se del las un por con no una su para es al lo como más o"
).split()


@dataclass(frozen=True)
class Threshold:
    """``measure`` may be at most / must be at least so many per mille of ``base``."""

    measure: str
    base: str
    at_least: int | None = None
    at_most: int | None = None

    @property
    def name(self) -> str:
        return f"{self.measure}_per_{self.base}"

    def holds(self, counts: Column) -> Column:
        measure, base = counts[self.measure] * 1000, counts[self.base]
        checks = F.lit(True)
        if self.at_least is not None:
            checks &= measure >= base * self.at_least
        if self.at_most is not None:
            checks &= measure <= base * self.at_most
        return checks


# Limits that no clean labelled document of the given tables breaks.
THRESHOLDS = (
    Threshold("word_chars", "n_words", at_least=2_000, at_most=20_000),
    Threshold("n_symbols", "n_words", at_most=200),
    Threshold("n_upper", "word_chars", at_most=500),
    Threshold("n_stop_words", "n_words", at_least=10),
    Threshold("n_dup_lines", "n_lines", at_most=700),
    Threshold("n_lines", "n_words", at_most=700),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_upper", "n_repeat_words")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once a row even where the optimizer merges projections and filters."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _window(items: Column, at: Column) -> list[Column]:
    return [F.get(items, at + k) for k in range(WINDOW)]


def _repeat_words(words: Column) -> Column:
    """Words inside windows that occur twice or more.

    A text whose windows have distinct hashes repeats none. Only the others sort the windows themselves.
    """
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)

    def covered(ordered: Column) -> Column:
        repeated = F.filter(
            ordered,
            lambda x, k: x["w"].eqNullSafe(F.get(ordered, k - 1)["w"])
            | x["w"].eqNullSafe(F.get(ordered, k + 1)["w"]),
        )
        return F.aggregate(
            F.sort_array(F.transform(repeated, lambda x: x["i"])),
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
            lambda acc, i: F.struct(
                i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    windows = F.transform(
        starts, lambda i: F.struct(F.concat_ws(" ", *_window(words, i)).alias("w"), i.alias("i"))
    )
    unequal = bind(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashes: bind(
            F.transform(starts, lambda i: F.xxhash64(*_window(hashes, i))),
            lambda h: F.size(F.array_distinct(h)) == F.size(h),
        ),
    )
    return F.when(F.size(words) < WINDOW, 0).when(unequal, 0).otherwise(bind(F.sort_array(windows), covered))


def counts(text: Column) -> Column:
    """The counts of ``COUNTS`` (long) as a struct."""
    whole = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(whole, f"[{SPACE}]+"), "")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))

    def named(**values: Column) -> Column:
        return F.struct(*(values[n].cast("long").alias(n) for n in COUNTS))

    return bind(
        words,
        lambda w: bind(
            lines,
            lambda ln: named(
                n_words=F.size(w),
                word_chars=F.length(F.array_join(w, "")),
                n_symbols=F.length(whole) - F.length(F.translate(whole, SYMBOLS, "")),
                n_lines=F.size(ln),
                n_dup_lines=F.size(ln) - F.size(F.array_distinct(ln)),
                n_stop_words=F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))),
                n_upper=F.length(F.regexp_replace(whole, r"\P{Lu}+", "")),
                n_repeat_words=_repeat_words(w),
            ),
        ),
    )


def verdict(text: Column, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> Column:
    """Counts, ``base_failed``, ``failed_rules`` (names of the thresholds that the text breaks) and ``kept`` as a struct.

    The base check fails a text of fewer than 20 words, or with more than 30 % of its words in repeated windows.
    """

    def judged(c: Column) -> Column:
        base = (c["n_words"] < 20) | (c["n_repeat_words"] * 100 > c["n_words"] * 30)
        broken = F.array_compact(F.array(*(F.when(~t.holds(c), F.lit(t.name)) for t in thresholds)))
        kept = ~base
        for t in thresholds:
            kept &= t.holds(c)
        return F.struct(
            *(c[n].alias(n) for n in COUNTS), base.alias("base_failed"), broken.alias("failed_rules"), kept.alias("kept")
        )

    return bind(counts(text), judged)


def judge(df: DataFrame, text: str = "text", thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """``df`` with the fields of ``verdict`` as columns."""
    added = [*COUNTS, "base_failed", "failed_rules", "kept"]
    judged = df.select(*replacing(df, *added), verdict(F.col(f"`{text}`"), thresholds).alias("__verdict"))
    return judged.select(*replacing(judged, "__verdict"), "__verdict.*")
