from tallystar.sinks.files import (
    write_csv,
    write_dated,
    write_parquet,
    write_run_date,
)
from tallystar.sinks.jdbc import append_new_rows, append_table, replace_dates
from tallystar.sinks.warehouse import Warehouse, bucket_count, store_bucketed

__all__ = [
    "Warehouse",
    "append_new_rows",
    "append_table",
    "bucket_count",
    "replace_dates",
    "store_bucketed",
    "write_csv",
    "write_dated",
    "write_parquet",
    "write_run_date",
]
