"""Files below a run date or partitioned by a date. Every write is safe to repeat."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.sources.files import CSV_DIALECT, NULL_MARK, SHARE, exists, is_text, run_path

# No output file grows beyond about this: files with quoted line breaks are read by one task each.
MAX_BYTES = 128 << 20


def write_csv(df: DataFrame, path: str, max_bytes: int = MAX_BYTES) -> None:
    """CSV with header in the dialect ``read_csv`` reads, replacing what is at ``path``.

    Each task adds up the bytes of its rows as they pass and begins a new file, in the next of its share folders, before
    one would have more than ``max_bytes``; a larger row has a file to itself. Nothing is shuffled. The running sum is the
    one thing here that goes over rows and not columns, so the rows pass a Python worker in Arrow batches. NULL is an empty field, or a mark in a table of one
    column, where the line would be blank.
    """
    texts = {f.name: F.col(f"`{f.name}`") for f in df.schema if is_text(f)}
    marked = {n: F.when(c.rlike(r"\A\x00+\z"), F.concat(c, F.lit(NULL_MARK))) for n, c in texts.items()}
    df = df.withColumns({n: marked[n].otherwise(c) for n, c in texts.items()})
    dialect = {**CSV_DIALECT, "nullValue": NULL_MARK if len(df.columns) == 1 else ""}
    # Static: the whole folder is replaced, not only the shares that occur.
    writer = _in_shares(df, max_bytes).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.options(**dialect).partitionBy(SHARE).csv(path)
    if not exists(df.sparkSession, f"{path.rstrip('/')}/{SHARE}=0"):  # no rows: a file with the header
        df.limit(0).write.options(**dialect).csv(f"{path.rstrip('/')}/{SHARE}=0")


def _in_shares(df: DataFrame, max_bytes: int) -> DataFrame:
    """``df`` with the number of each row's file in its task, from the running sum of the rows' bytes."""
    # A field is at most its text with every quote doubled, two quotes around it and a separator.
    fields = [F.col(f"`{f.name}`").cast("string") for f in df.schema]
    texts = [F.octet_length(c) + F.length(c) - F.length(F.replace(c, F.lit('"'))) for c in fields]
    size = reduce(Column.__add__, (F.coalesce(n, F.lit(0)).cast("long") + 3 for n in texts))
    schema = T.StructType([*df.schema.fields, T.StructField(SHARE, T.IntegerType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = filled = 0
        for batch in batches:
            place = batch.schema.get_field_index(SHARE)
            ends = np.cumsum(batch.column(place).to_numpy())
            shares = np.zeros(len(ends), dtype=np.int32)
            at = before = 0
            while at < len(ends):
                stop = int(np.searchsorted(ends, before + max_bytes - filled, side="right"))
                if stop <= at and filled:
                    share, filled = share + 1, 0
                    continue
                stop = max(stop, at + 1)
                shares[at:stop] = share
                filled, before, at = filled + int(ends[stop - 1]) - before, int(ends[stop - 1]), stop
            columns = [*batch.columns[:place], pa.array(shares), *batch.columns[place + 1 :]]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return df.withColumn(SHARE, size).mapInArrow(work, schema)


def write_run_date(df: DataFrame, root: str, run_date: dt.date, file_format: str) -> str:
    """Replace one run date of a dataset, also if it is now empty; other dates stay untouched."""
    path = run_path(root, run_date)
    if file_format == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").format(file_format).save(path)
    return path


def write_dated(df: DataFrame, root: str, file_format: str, by: Sequence[str]) -> None:
    """Partition by date columns and replace only the partitions that occur in ``df``.

    The rebalance brings the rows of one date together, so that a date does not get a file from every task, and
    adaptive execution splits a date that is much larger than the others over several tasks.
    """
    writer = df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by)
    writer.option("partitionOverwriteMode", "dynamic").format(file_format).save(root)


def write_parquet(df: DataFrame, path: str, replace: bool = False) -> None:
    """Parquet at ``path``; without ``replace`` it is an error if something is there already."""
    df.write.mode("overwrite" if replace else "errorifexists").parquet(path)
