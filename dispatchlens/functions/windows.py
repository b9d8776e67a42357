"""Event-time windows: one place for watermark, window and window columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

WINDOW = "1 minute"
LATENESS = "30 seconds"


def per_window(
    events: DataFrame, *keys: str, window: str = WINDOW, lateness: str = LATENESS
) -> GroupedData:
    """Group events by tumbling event-time window and keys.

    The watermark is ignored on batch frames, so the same call serves a table
    and a stream.  Filter before calling: only rows that reach this point move
    the watermark.
    """
    return events.withWatermark("event_timestamp", lateness).groupBy(
        F.window("event_timestamp", window), *keys
    )


def with_window_columns(aggregated: DataFrame, *columns: str | Column) -> DataFrame:
    """Replace the window struct by window_start, window_end and window_date."""
    start = F.col("window.start")
    return aggregated.select(
        start.alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.to_date(start).alias("window_date"),
        *columns,
    )
