"""Feed summaries and data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..dimensions import LATE_LAG_MS
from ..functions.domain import lag_millis
from ..functions.numbers import exact_percentile


def status_counts(orders: DataFrame) -> DataFrame:
    """Order events by status, copies and duplicates included."""
    return orders.groupBy("order_status").agg(F.count("*").alias("events")).orderBy("order_status")


def anomaly_counts(couriers: DataFrame) -> DataFrame:
    """Courier events by anomaly flag, unflagged events included."""
    return couriers.groupBy("anomaly_flag").agg(F.count("*").alias("events"))


def edge_case_counts(orders: DataFrame, couriers: DataFrame) -> DataFrame:
    """Duplicates, late arrivals and anomalies of both feeds in one row."""
    both = orders.select(
        F.lit(True).alias("is_order"), "is_duplicate", "is_late_arrival", F.lit(False).alias("odd")
    ).unionByName(
        couriers.select(
            F.lit(False).alias("is_order"),
            "is_duplicate",
            "is_late_arrival",
            F.col("anomaly_flag").isNotNull().alias("odd"),
        )
    )
    of_order, duplicate, late = F.col("is_order"), F.col("is_duplicate"), F.col("is_late_arrival")
    return both.agg(
        F.count_if(of_order & duplicate).alias("order_duplicates"),
        F.count_if(of_order & late).alias("order_late_arrivals"),
        F.count_if(~of_order & duplicate).alias("courier_duplicates"),
        F.count_if(~of_order & late).alias("courier_late_pings"),
        F.count_if("odd").alias("courier_anomalies"),
        F.count("*").alias("total_events"),
    )


def timeline(orders: DataFrame, couriers: DataFrame) -> DataFrame:
    """Both feeds as one list of events in order of ingestion."""

    def events(feed: DataFrame, name: str, entity: str, status: str) -> DataFrame:
        return feed.select(
            F.lit(name).alias("feed"),
            "event_id",
            F.col(entity).alias("entity_id"),
            F.col(status).alias("status"),
            "zone_id",
            "event_timestamp",
            "ingestion_timestamp",
        )

    return (
        events(orders, "orders", "order_id", "order_status")
        .unionByName(events(couriers, "couriers", "courier_id", "courier_status"))
        .orderBy("ingestion_timestamp", "event_id")
    )


def late_arrivals(orders: DataFrame, couriers: DataFrame, limit_ms: int = LATE_LAG_MS) -> DataFrame:
    """Ingestion lag per feed and zone, and how far the late flag agrees.

    A negative lag (an event stamped after its ingestion) is counted apart and
    kept out of the lag statistics.
    """

    def lags(feed: DataFrame, name: str) -> DataFrame:
        return feed.select(
            F.lit(name).alias("feed"),
            "zone_id",
            F.col("is_late_arrival").alias("flagged"),
            lag_millis(F.col("ingestion_timestamp"), F.col("event_timestamp")).alias("raw"),
        )

    late = F.col("raw") > limit_ms
    rows = (
        lags(orders, "orders")
        .unionByName(lags(couriers, "couriers"))
        .withColumn("lag_ms", F.when(F.col("raw") >= 0, F.col("raw")))
        .withColumn("lag_s", F.expr("lag_ms div 1000"))
    )
    return rows.groupBy("feed", "zone_id").agg(
        F.count("*").alias("events"),
        F.count_if(late).alias("late_by_lag"),
        F.count_if("flagged").alias("late_by_flag"),
        F.count_if(late == F.col("flagged")).alias("agreeing"),
        F.count_if(F.col("raw") < 0).alias("negative_lag"),
        F.round(F.avg("lag_ms"), 2).alias("avg_lag_ms"),
        F.max("lag_ms").alias("max_lag_ms"),
        exact_percentile("lag_s", 0.95).cast("bigint").alias("p95_lag_s"),
    )


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """First row per key.  Spark keeps one row per key before the shuffle as
    well (group limit), so a key with very many rows costs no more than others."""
    ranked = rows.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col("rank") == 1).drop("rank")


def dedup_orders(orders: DataFrame) -> DataFrame:
    """One row per event id: the one ingested first."""
    return first_per_key(orders, ["event_id"], ["ingestion_timestamp", "is_duplicate"])


def dedup_couriers(couriers: DataFrame) -> DataFrame:
    """One row per courier, session, time and status; copies carry a new id."""
    keys = ["courier_id", "session_id", "event_timestamp", "courier_status"]
    return first_per_key(couriers, keys, ["ingestion_timestamp", "is_duplicate", "event_id"])


def enum_violations(feed: DataFrame, name: str, symbols: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows per enum column whose value is outside the allowed symbols."""
    counts = feed.agg(
        *[F.count_if(~F.col(column).isin(*allowed)).alias(column) for column, allowed in symbols.items()]
    )
    return counts.unpivot([], list(symbols), "column_name", "violations").select(
        F.lit(name).alias("feed"), "column_name", "violations"
    )


def offline_mid_delivery(couriers: DataFrame) -> DataFrame:
    """Couriers that went offline with an order on hand, against the flag."""
    found = (F.col("courier_status") == "OFFLINE") & F.col("order_id").isNotNull()
    flagged = F.coalesce(F.col("anomaly_flag") == "OFFLINE_MID_DELIVERY", F.lit(False))
    return couriers.groupBy("zone_id").agg(
        F.count_if(found).alias("detected"),
        F.count_if(flagged).alias("flagged"),
        F.count_if(found & flagged).alias("agreeing"),
    )
