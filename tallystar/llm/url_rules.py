"""URL filtering with a list of rules and, where no listed rule fits, with mined association rules.

A URL's tokens are the labels and the two-label domain of its host, its path segments (numbers alike), its file
extension and its query keys. Spark's FP-growth mines the token combinations of all URLs together with the labels of
those that have one; a combination becomes a rule if it is frequent enough and if at least ``MIN_CONFIDENCE`` of the
URLs that have it carry the label. URLs without a label count against it. Tokens that occur in exactly the same URLs, such
as the query keys of a template, are one item: every set of them says the same, and mined one by one they would give a
number of item sets that doubles with each. Rules match by an inverted index: each is
filed under its rarest token, and a URL is only held against the rules filed under its tokens.

The URLs are reduced to their distinct token sets before they are matched, so a host with a third of all pages is a
few rows. Among rules that match, the most confident decides, then the one with more support, then block before
allow, then the antecedent. A URL that no rule matches is allowed.

Defined results: a null url, or one without ``://``, has empty host and path, no tokens, and is allowed. Repeated rows
are judged alike. Without labelled URLs nothing is mined. Input columns of the names that are added give way. A URL of any
length is judged whole; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import replacing
from tallystar.scratch import stage

MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
LABEL = "="  # marks the items that are labels; no token starts with it
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and a path prefix, as in ``example.com/en/``."""

    text: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


# Fixed values.
RULES = (
    Rule("com/", "allow"),
    Rule("example.com/en/", "block"),
    Rule("www.example.com/en/", "allow"),
    Rule("net/es/", "block"),
    Rule("net/fr/", "block"),
)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens in sorted order."""

    def marked(mark: str, values: Column) -> Column:
        kept = F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: v != "")
        return F.transform(kept, lambda v: F.concat(F.lit(mark), v))

    segments = F.transform(F.split(path, "/"), lambda s: F.regexp_replace(s, r"\d+", "#"))
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda pair: F.split_part(pair, F.lit("="), F.lit(1)))
    parts = [
        marked("host:", F.split(host, r"\.")),
        marked("domain:", F.array(F.regexp_extract(host, r"[^.]+\.[^.]+$", 0))),
        marked("path:", segments),
        marked("type:", F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))),
        marked("query:", keys),
    ]
    return F.array_sort(F.array_distinct(F.concat(*parts)))


def listed(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule of the list that fits, as a struct of ``rule`` and ``verdict``; null if none does."""
    longest_first = sorted(rules, key=lambda r: (-len(r.text), r.text))
    return F.coalesce(
        F.lit(None).cast("struct<rule:string,verdict:string>"),
        *(
            F.when(r.fits(host, path), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")))
            for r in longest_first
        ),
    )


def _representatives(urls: DataFrame, min_support: float) -> list[str]:
    """The tokens that rules are mined from: of the frequent ones that occur in exactly the same URLs, the last by name.

    There are no more than the tokens of a URL on average, divided by the support. Which URLs a token occurs in is
    compared by two sums over the hashes of their token sets.
    """
    least = F.ceil(F.lit(min_support) * urls.count()).cast("long")
    of_set = [F.xxhash64(F.lit(k), "tokens").cast("decimal(38,0)").alias(f"h{k}") for k in (0, 1)]
    rows = urls.select(F.explode("tokens").alias("token"), *of_set)
    places = rows.groupBy("token").agg(F.count("*").alias("n"), F.sum("h0").alias("h0"), F.sum("h1").alias("h1"))
    same = places.where(F.col("n") >= least).groupBy("n", "h0", "h1").agg(F.max("token").alias("token"))
    return [r["token"] for r in same.select("token").collect()]


def mine(urls: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules from ``urls`` with the columns ``tokens`` and ``label`` (null where unlabelled).

    Returns ``antecedent``, ``label``, ``confidence``, ``support`` and ``filed``, the antecedent's rarest token.
    """
    spark = urls.sparkSession
    schema = "antecedent array<string>, label string, confidence double, support double, filed string"
    if urls.where("label is not null").isEmpty():
        return spark.createDataFrame([], schema)
    chosen = F.lit(_representatives(urls, min_support)).cast("array<string>")
    label = F.when(F.col("label").isNotNull(), F.array(F.concat(F.lit(LABEL), F.col("label"))))
    items = urls.select(F.concat(F.array_intersect("tokens", chosen), F.coalesce(label, F.array().cast("array<string>"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    # Association rules of Spark have one consequent; the antecedents that hold labels are not of use.
    rules = model.associationRules.where(F.col("consequent")[0].startswith(LABEL))
    rules = rules.where(~F.exists("antecedent", lambda t: t.startswith(LABEL)))
    rules = rules.select(
        F.array_sort("antecedent").alias("antecedent"),
        F.substring(F.col("consequent")[0], len(LABEL) + 1, 1 << 20).alias("label"),
        "confidence",
        "support",
    )
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = rules.select("antecedent", "label", F.explode("antecedent").alias("token")).join(single, "token")
    rarest = rarest.groupBy("antecedent", "label").agg(F.min(F.struct("freq", "token"))["token"].alias("filed"))
    return _shortest(stage(rules.join(rarest, ["antecedent", "label"]), "url-rules"))


def _shortest(rules: DataFrame) -> DataFrame:
    """Without the rules of which a part is a rule for the same label that is no less confident."""
    part = rules.select("filed", "label", F.col("antecedent").alias("part"), F.col("confidence").alias("sure"))
    whole = rules.withColumn("filed", F.explode("antecedent")).select("filed", "label", "antecedent", "confidence")
    held = whole.join(part, ["filed", "label"]).where(
        (F.size("part") < F.size("antecedent"))
        & (F.size(F.array_except("part", "antecedent")) == 0)
        & (F.col("sure") >= F.col("confidence"))
    )
    return rules.join(held.select("antecedent", "label").distinct(), ["antecedent", "label"], "left_anti")


def match(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Columns ``tokens``, ``label``, ``antecedent``: the deciding rule of each distinct token set that one matches."""
    sets = token_sets.select("tokens").distinct()
    found = sets.withColumn("filed", F.explode("tokens")).join(rules, "filed")
    found = found.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    # array<string> has an order, so the best rule is a maximum; labels sort allow before block.
    best = F.max(F.struct("confidence", "support", "label", "antecedent"))
    return found.groupBy("tokens").agg(best.alias("best")).select("tokens", "best.label", "best.antecedent")


def judge(pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``mined`` (the tokens of the mined rule, if one
    decided). The labels that are learnt from are the verdicts of the list."""
    added = ["host", "path", "rule", "verdict", "mined"]
    address = F.col("__url")
    rows = pages.select(*replacing(pages, *added), F.col(f"`{url}`").alias("__url"))
    rows = rows.withColumns({"host": host_of(address), "path": path_of(address)})
    rows = rows.withColumn("__listed", listed(F.col("host"), F.col("path"), rules))
    tokens = tokens_of(address, F.col("host"), F.col("path"))
    rows = rows.withColumn("__tokens", tokens)
    known = rows.select(F.col("__tokens").alias("tokens"), F.col("__listed.verdict").alias("label"))
    mined = stage(match(known.where("label is null"), mine(known.where(F.size("tokens") > 0))), "mined-verdicts")
    mined = mined.select(F.col("tokens").alias("__tokens"), F.col("label").alias("__label"), "antecedent")
    # Only rows that the list leaves open are looked up; the staged verdicts are broadcast if small, else AQE splits
    # the rows of a frequent token set.
    decided = rows.where("__listed is not null").withColumns(
        {"__label": F.lit(None).cast("string"), "antecedent": F.lit(None).cast("array<string>")}
    )
    out = decided.unionByName(rows.where("__listed is null").join(mined, "__tokens", "left"))
    return out.select(
        *replacing(pages, *added),
        "host",
        "path",
        F.col("__listed.rule").alias("rule"),
        F.coalesce("__listed.verdict", "__label", F.lit("allow")).alias("verdict"),
        F.concat_ws(" ", "antecedent").alias("mined"),
    )
