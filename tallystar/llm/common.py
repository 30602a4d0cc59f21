"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.session import configure

# Rows that travel to a Python worker at once. Texts are of any length, so batches are also bounded in bytes.
BATCH_ROWS = 512
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings of the queries in this subpackage."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def replacing(df: DataFrame, *names: str) -> list[Column]:
    """The columns of ``df`` except those that the caller is about to add: a clashing input column gives way."""
    taken = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]


def texts(batch: pa.RecordBatch, name: str) -> Iterator[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def gathered(batches: Iterator[pa.RecordBatch], name: str, size: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, for work that is cheaper on many rows at once."""
    held: list[pa.RecordBatch] = []
    filled = 0
    for batch in batches:
        held.append(batch)
        filled += batch.column(batch.schema.get_field_index(name)).nbytes
        if filled >= size:
            yield pa.concat_batches(held)
            held, filled = [], 0
    if held:
        yield pa.concat_batches(held)


def parted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in batches of the usual number of rows."""
    for at in range(0, batch.num_rows, BATCH_ROWS):
        yield batch.slice(at, BATCH_ROWS)


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with columns added, replacing those of the same name."""
    arrays = {n: c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in columns}
    return pa.RecordBatch.from_pydict(arrays | columns)
