"""Whole jobs: from feeds to result datasets, and from those to reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from .operators import quality
from .plans.catalog import ANALYTICS, REPORTS
from .schemas import COURIER_FEED, ORDER_FEED
from .sources import files, kafka

Feeds = dict[str, DataFrame]

ORDERS, COURIERS = "orders", "couriers"


def stored_feeds(
    spark: SparkSession,
    base: str,
    streaming: bool = False,
    first_date: str | None = None,
    last_date: str | None = None,
    **options: str,
) -> Feeds:
    """Both feeds from parquet folders below ``base``, whole or between two dates."""
    bounds = {"first_date": first_date, "last_date": last_date, **options}
    return {
        name: files.read_feed(spark, f"{base}/{name}", schema, streaming, **bounds)
        for name, schema in ((ORDERS, ORDER_FEED), (COURIERS, COURIER_FEED))
    }


def topic_feeds(
    spark: SparkSession,
    connection: Mapping[str, str],
    orders_topic: str,
    couriers_topic: str,
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
) -> Feeds:
    """Both feeds from Kafka topics that carry Avro records."""
    offsets = {"starting_offsets": starting_offsets, "max_offsets": max_offsets}
    return {
        ORDERS: kafka.order_stream(spark, orders_topic, connection, **offsets),
        COURIERS: kafka.courier_stream(spark, couriers_topic, connection, **offsets),
    }


def store_feeds(feeds: Feeds, base: str, mode: str = "errorifexists") -> None:
    """Write feeds to parquet once, so that many jobs share one decoding."""
    for name, feed in feeds.items():
        files.write_feed(feed, f"{base}/{name}", mode)


def run_batch(feeds: Feeds, base: str, names: Iterable[str] = tuple(ANALYTICS)) -> None:
    """Compute analytics over feeds; the dates in them replace those in the datasets."""
    for name in names:
        files.write_results(ANALYTICS[name](feeds), base, name)


def report(
    spark: SparkSession,
    name: str,
    base: str,
    first_date: str | None = None,
    last_date: str | None = None,
) -> DataFrame:
    """A report over stored results; only the dates asked for are read."""
    source, rollup = REPORTS[name]
    return rollup(files.read_results(spark, base, source, first_date, last_date))


def feed_summary(feeds: Feeds) -> dict[str, DataFrame]:
    """Event counts by status and by flag, and the edge cases of both feeds."""
    return {
        "status": quality.status_counts(feeds[ORDERS]),
        "anomaly": quality.anomaly_counts(feeds[COURIERS]),
        "edge cases": quality.edge_case_counts(feeds[ORDERS], feeds[COURIERS]),
    }
