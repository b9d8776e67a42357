"""Start, watch and stop the streaming analytics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.catalog import ANALYTICS


def parquet_sink(
    results: DataFrame,
    name: str,
    output_base: str,
    checkpoint_base: str,
    partition_by: Sequence[str] = ("window_date",),
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Append a streaming result to parquet with a checkpoint of its own.

    A window is written once, when the watermark has passed its end.  Rows of a partition go to one
    task, so that a batch writes a file for each of its dates, not one for each date and shuffle
    partition.  Bases may be any URI Hadoop knows.  ``available_now`` handles the input at hand and
    ends; ``interval`` sets a processing-time trigger.
    """
    if partition_by:
        results = results.repartition(*partition_by)
    writer = (
        results.writeStream.format("parquet")
        .queryName(name)
        .outputMode("append")
        .option("path", f"{output_base.rstrip('/')}/{name}")
        .option("checkpointLocation", f"{checkpoint_base.rstrip('/')}/{name}")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def start_all(
    feeds: dict[str, DataFrame],
    output_base: str,
    checkpoint_base: str,
    names: Iterable[str] = tuple(ANALYTICS),
    **sink_options,
) -> list[StreamingQuery]:
    """Start the analytics side by side; each reads its feeds for itself."""
    started: list[StreamingQuery] = []
    try:
        for name in names:
            results = ANALYTICS[name](feeds)
            started.append(
                parquet_sink(results, name, output_base, checkpoint_base, **sink_options)
            )
    except BaseException:
        stop_all(started)
        raise
    return started


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.stop()


def run_until_stopped(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait for any query to end, then stop the others.

    A failed query raises here; Ctrl-C stops everything in good order.
    """
    try:
        spark.streams.awaitAnyTermination()
    except KeyboardInterrupt:
        pass
    finally:
        stop_all(queries)


def finish_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait until queries over a finite input have ended."""
    queries = list(queries)
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        stop_all(queries)
