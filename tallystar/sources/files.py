"""Scans of landed files. Paths follow ``root/<column>=<value>/``, so a date is found by its folder."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.scratch import stage

# What PostgreSQL's COPY ... CSV writes: quotes are doubled, quoted fields may hold line breaks, an unquoted
# empty field is NULL and a quoted one is the empty string. Spaces at either end belong to the value.
CSV_DIALECT = {
    "header": True,
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
CORRUPT = "_corrupt_record"
# The folders that ``write_csv`` divides the rows of a task into, so that no file outgrows its bound.
SHARE = "_share"
# Stands for an unquoted empty field while a file is parsed, so that a quoted one stays the empty string. Database
# text cannot hold this character. ``write_csv`` adds one to values that consist of it alone, the readers take it away.
NULL_MARK = "\0"


def is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType) and field.name != CORRUPT


def _csv_options(line_breaks: bool) -> dict[str, str | bool]:
    # Files with quoted line breaks cannot be split, so the sink bounds the size of each file.
    return {**CSV_DIALECT, "multiLine": line_breaks, "nullValue": NULL_MARK}


def _without_mark(df: DataFrame) -> DataFrame:
    texts = {f.name: F.col(f"`{f.name}`") for f in df.schema if is_text(f)}
    marked = {n: F.when(c.rlike(r"\A\x00{2,}\z"), F.expr(f"substring(`{n}`, 2)")) for n, c in texts.items()}
    return df.withColumns({n: marked[n].otherwise(c) for n, c in texts.items()})


def _unreadable(schema: T.StructType) -> Column:
    """Whether a row that the parser found corrupt is: a quoted empty field is just a NULL in a column of no text."""
    names = ", ".join(f"`{f.name}` STRING" for f in [*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {**_csv_options(True), "columnNameOfCorruptRecord": CORRUPT}
    raw = F.from_csv(F.col(CORRUPT), names, {k: str(v).lower() if v in (True, False) else v for k, v in options.items()})
    lost = [F.col(f"`{f.name}`").isNull() & (raw[f.name] != "") for f in schema if not is_text(f)]
    return reduce(Column.__or__, [F.coalesce(x, F.lit(False)) for x in lost], raw[CORRUPT].isNotNull())


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    keep_corrupt: bool = False,
    base_path: str | None = None,
) -> DataFrame:
    """CSV with a header and a declared schema.

    Columns are bound by position, so a header in another order is an error rather than silent NULLs. A value
    that does not fit its type becomes NULL; ``keep_corrupt`` adds the raw row as ``_corrupt_record``. Files
    of several columns without a text hold no quoted line breaks, so they are split over tasks. Blank lines are
    skipped; ``write_csv`` therefore never writes one.
    """
    line_breaks = len(schema) == 1 or any(is_text(f) for f in schema)
    declared = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if keep_corrupt else schema
    reader = spark.read.options(**_csv_options(line_breaks)).schema(declared).option("enforceSchema", False)
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    df = reader.csv(path)
    if SHARE not in declared.names:
        df = df.drop(SHARE)
    if keep_corrupt:
        df = df.withColumn(CORRUPT, F.when(F.col(CORRUPT).isNotNull() & _unreadable(schema), F.col(CORRUPT)))
    return _without_mark(df)


# The types that a column of text can be inferred as, the narrowest first: what a value looks like, and the type it must
# then fit. A column gets the first type that all of its values have, else it is text.
_LOOKS = {
    "INT": r"[+-]?\d{1,10}",
    "BIGINT": r"[+-]?\d{1,19}",
    "DECIMAL(38,0)": r"[+-]?\d{1,38}",
    "DOUBLE": r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[+-]?Infinity|-?Inf|NaN",
    "DATE": r"\d{4}-\d{2}-\d{2}",
    "TIMESTAMP_NTZ": r"\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)?",
    "BOOLEAN": r"(?i)true|false",
}


def infer_types(texts: DataFrame) -> dict[str, str]:
    """The narrowest type of each column of text: one aggregate over all rows and columns, inside generated code.

    NULL and the empty text have every type. A column without any other value is text.
    """
    checks = []
    for i, name in enumerate(texts.columns):
        value = F.col(f"`{name}`")
        given = value.isNotNull() & (value != "")
        checks.append(F.bool_or(given).alias(f"{i}"))
        for kind, look in _LOOKS.items():
            fits = value.rlike(rf"\A({look})\z") & value.try_cast(kind).isNotNull()
            checks.append(F.bool_and(~given | fits).alias(f"{i} {kind}"))
    found = texts.agg(*checks).first()
    kinds = {}
    for i, name in enumerate(texts.columns):
        fitting = [k for k in _LOOKS if found[f"{i} {k}"]] if found[f"{i}"] else []
        kinds[name] = fitting[0] if fitting else "STRING"
    return kinds


def read_csv_inferred(spark: SparkSession, path: str | list[str], line_breaks: bool = True) -> DataFrame:
    """CSV with types inferred from all rows. The files are parsed once, into staged columns of text.

    A quoted empty field is NULL in a column that is not text. Files of several columns that are known to hold no quoted
    line breaks are split over tasks without ``line_breaks``.
    """
    texts = spark.read.options(**_csv_options(line_breaks)).option("inferSchema", False).csv(path).drop(SHARE)
    texts = stage(texts, "texts")
    kinds = infer_types(texts)
    typed = {n: F.col(f"`{n}`").try_cast(kind) for n, kind in kinds.items() if kind != "STRING"}
    return _without_mark(texts.withColumns(typed) if typed else texts)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    base_path: str | None = None,
    whole_files: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """JSON with a declared schema: one object per line, or a line that holds an array of objects.

    ``whole_files`` reads each file as one document that may go over several lines. What does not parse becomes
    NULL; ``keep_corrupt`` adds its text as ``_corrupt_record``.
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", whole_files).option("columnNameOfCorruptRecord", CORRUPT)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    return reader.json(path)


def read_json_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.json(path)


def read_json_merged(
    spark: SparkSession, path: str | list[str], base_path: str | None = None, keep_corrupt: bool = False
) -> DataFrame:
    """JSON lines whose objects need not have the same fields, such as a feed of several dates.

    Each line is parsed once, into a staged VARIANT; one aggregate merges the schemas of all values, and a second read
    of the stage takes the fields out. A field that an object lacks is NULL; one of numbers with fractions is a double,
    one of different kinds is text. Partition columns below ``base_path`` follow the fields, which must not share their
    names. A line that is no object has NULL in all fields; ``keep_corrupt`` adds its text as ``_corrupt_record``.
    """
    reader = spark.read if base_path is None else spark.read.option("basePath", base_path)
    lines = reader.text(path)
    folders = [c for c in lines.columns if c != "value"]
    parsed = F.try_parse_json("value")
    parsed = F.when(F.schema_of_variant(parsed).startswith("OBJECT<"), parsed)
    corrupt = F.when(parsed.isNull(), F.col("value")).alias(CORRUPT)
    rows = stage(lines.select(parsed.alias("_object"), corrupt, *folders), "json")
    merged = rows.agg(F.schema_of_variant_agg("_object")).first()[0]
    schema = _declared(merged)
    fields = [] if schema is None else [F.try_variant_get("_object", "$", schema).alias("_fields")]
    out = rows.select(*fields, CORRUPT, *folders)
    return out.select(*(["_fields.*"] if fields else []), *([CORRUPT] if keep_corrupt else []), *folders)


def _declared(merged: str) -> str | None:
    """The type of the merged objects in the form of a declared one; None if there was no field."""
    if not merged.startswith("OBJECT<") or merged == "OBJECT<>":
        return None
    kinds = re.sub(r"DECIMAL\(\d+,\s*0\)", "DECIMAL(38,0)", merged.replace("OBJECT<", "STRUCT<"))
    kinds = re.sub(r"DECIMAL\(\d+,\s*[1-9]\d*\)", "DOUBLE", kinds)
    return re.sub(r"\b(VOID|VARIANT)\b", "STRING", kinds)


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def run_path(root: str, run_date: dt.date) -> str:
    return f"{root.rstrip('/')}/run_date={run_date.isoformat()}"


def read_run_date(spark: SparkSession, root: str, run_date: dt.date) -> DataFrame:
    """One run date of a Parquet dataset that is partitioned by ``run_date``; only its folder is listed."""
    return spark.read.option("basePath", root).parquet(run_path(root, run_date))


@dataclass(frozen=True)
class Evolution:
    """How the columns of a dataset may differ between run dates.

    ``schema`` is what a read gives. A column in ``added`` may be missing from a date and then has the given value; the
    type of a column in ``widened`` may be one of those listed; ``renamed`` gives earlier names of a column. All other
    differences are errors, also columns that the schema does not have, unless they are listed in ``dropped``.
    """

    schema: T.StructType
    added: Mapping[str, Any] = field(default_factory=dict)
    widened: Mapping[str, Sequence[str]] = field(default_factory=dict)
    renamed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    dropped: Sequence[str] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        """The rows of one date with the declared columns; an error if the rule does not cover its columns."""
        given = {f.name: f.dataType for f in df.schema}
        columns, used = [], set(self.dropped)
        for declared in self.schema:
            names = [n for n in (declared.name, *self.renamed.get(declared.name, ())) if n in given]
            if len(names) > 1:
                raise ValueError(f"{declared.name} has several names: {', '.join(names)}")
            if not names:
                if declared.name not in self.added:
                    raise ValueError(f"{declared.name} is missing")
                columns.append(F.lit(self.added[declared.name]).cast(declared.dataType).alias(declared.name))
                continue
            (name,) = names
            used.add(name)
            kind = given[name].simpleString()
            if given[name] != declared.dataType and kind not in self.widened.get(declared.name, ()):
                raise ValueError(f"{declared.name} is {kind}")
            columns.append(F.col(f"`{name}`").cast(declared.dataType).alias(declared.name))
        unknown = set(given) - used
        if unknown:
            raise ValueError(f"columns that are not declared: {', '.join(sorted(unknown))}")
        return df.select(*columns)


def read_evolved(
    spark: SparkSession, root: str, rule: Evolution, dates: Sequence[dt.date], column: str = "run_date"
) -> DataFrame:
    """Run dates of a Parquet dataset whose columns changed over time, with the columns of ``rule`` and the date.

    The schema of each date is read from its files, not merged in file order; dates with the same columns are one scan,
    in which conditions and the choice of columns still reach the files. A date that is missing is an error.
    """
    dated = replace(rule, schema=T.StructType([*rule.schema.fields, T.StructField(column, T.DateType())]))
    groups: dict[str, list[dt.date]] = {}
    schemas: dict[str, T.StructType] = {}
    for day in sorted(set(dates)):
        found = spark.read.parquet(run_path(root, day)).schema
        key = found.simpleString()
        schemas[key] = found
        groups.setdefault(key, []).append(day)
    parts = []
    for key, days in groups.items():
        whole = T.StructType([*schemas[key].fields, T.StructField(column, T.DateType())])
        reader = spark.read.schema(whole).option("basePath", root)
        rows = reader.parquet(*(run_path(root, day) for day in days))
        parts.append(dated.apply(rows))
    return reduce(DataFrame.unionByName, parts)


def read_feed_dates(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    dates: Sequence[dt.date],
    column: str = "date",
    allow_missing: bool = False,
) -> DataFrame:
    """The feed of the given dates. Only their folders are listed.

    It is an error if one of them has not landed, unless ``allow_missing`` is set and another one has.
    """
    folders = {day: f"{root.rstrip('/')}/{column}={day.isoformat()}" for day in dates}
    missing = [day.isoformat() for day, folder in folders.items() if not exists(spark, folder)]
    if missing and not (allow_missing and len(missing) < len(folders)):
        raise FileNotFoundError(f"no feed in {root} for {', '.join(missing)}")
    days = ",".join(day.isoformat() for day in folders if day.isoformat() not in missing)
    return read_json(spark, f"{root.rstrip('/')}/{column}={{{days}}}", schema, base_path=root)


def read_feed_day_before(
    spark: SparkSession, root: str, schema: T.StructType, run_date: dt.date, column: str = "date"
) -> DataFrame:
    """The feed of the day before the run; an error if it has not landed."""
    return read_feed_dates(spark, root, schema, [run_date - dt.timedelta(days=1)], column)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
