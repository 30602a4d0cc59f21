from tallystar.functions.temporal import (
    calendar_columns,
    date_key,
    day_before,
    elapsed,
    epoch_seconds,
    hour_component,
    iso_date,
    total_hours,
)

__all__ = [
    "calendar_columns",
    "date_key",
    "day_before",
    "elapsed",
    "epoch_seconds",
    "hour_component",
    "iso_date",
    "total_hours",
]
