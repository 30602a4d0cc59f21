from tallystar.sources.files import (
    Evolution,
    infer_types,
    read_csv,
    read_csv_inferred,
    read_evolved,
    read_feed_dates,
    read_feed_day_before,
    read_json,
    read_json_inferred,
    read_json_merged,
    read_parquet,
    read_run_date,
)
from tallystar.sources.jdbc import Database, Ranges, list_tables, read_table, read_tables

__all__ = [
    "Database",
    "Evolution",
    "Ranges",
    "infer_types",
    "list_tables",
    "read_csv",
    "read_csv_inferred",
    "read_evolved",
    "read_feed_dates",
    "read_feed_day_before",
    "read_json",
    "read_json_inferred",
    "read_json_merged",
    "read_parquet",
    "read_run_date",
    "read_table",
    "read_tables",
]
