"""Windowed analytics over the order feed.

Each function takes the order feed as a table or a stream and returns one row
per window and key.  Rows with a true or null ``is_duplicate`` never count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dimensions import PREP_SLA_SECONDS
from ..functions.numbers import half_up_quotient, percent
from ..functions.windows import per_window, with_window_columns


def originals(feed: DataFrame) -> DataFrame:
    return feed.filter(~F.col("is_duplicate"))


def in_status(feed: DataFrame, status: str, *required: str) -> DataFrame:
    """Non-duplicate order events of one status with the required fields set."""
    rows = originals(feed).filter(F.col("order_status") == status)
    for name in required:
        rows = rows.filter(F.col(name).isNotNull())
    return rows


def late_preparations(orders: DataFrame, limit_seconds: int = PREP_SLA_SECONDS) -> DataFrame:
    """Preparations that took longer than the limit."""
    return finished_preparations(orders).filter(F.col("actual_prep_time_seconds") > limit_seconds)


def finished_preparations(orders: DataFrame) -> DataFrame:
    return in_status(orders, "READY_FOR_PICKUP", "actual_prep_time_seconds")


def timed_deliveries(orders: DataFrame) -> DataFrame:
    """Deliveries with their time; rating copies are among them."""
    return in_status(orders, "DELIVERED", "actual_delivery_time_seconds")


def placements(orders: DataFrame) -> DataFrame:
    return in_status(orders, "PLACED")


def priced_placements(orders: DataFrame) -> DataFrame:
    return in_status(orders, "PLACED", "order_total_cents")


def promised_placements(orders: DataFrame) -> DataFrame:
    return in_status(orders, "PLACED", "estimated_delivery_time_seconds")


def _mean_seconds(name: str) -> Column:
    return F.round(F.avg(name), 0)


def order_volume(orders: DataFrame, **timing: str) -> DataFrame:
    """Placed and cancelled orders per zone; the rate compares both within the
    window, so it may pass 100 and is 0.0 where nothing was placed."""
    status = F.col("order_status")
    counts = per_window(originals(orders), "zone_id", **timing).agg(
        F.count_if(status == "PLACED").alias("total_orders"),
        F.count_if(status == "CANCELLED").alias("cancelled_orders"),
    )
    rate = F.round(percent(F.col("cancelled_orders"), F.col("total_orders")), 2)
    return with_window_columns(
        counts, "zone_id", "total_orders", "cancelled_orders", rate.alias("cancellation_rate")
    )


def prep_sla_breaches(
    orders: DataFrame, limit_seconds: int = PREP_SLA_SECONDS, **timing: str
) -> DataFrame:
    """Orders whose preparation took longer than the limit, per restaurant."""
    prep = "actual_prep_time_seconds"
    keys = ("zone_id", "restaurant_id", "is_peak_hour")
    late = late_preparations(orders, limit_seconds)
    breaches = per_window(late, *keys, **timing).agg(
        F.count("*").alias("breach_count"),
        _mean_seconds(prep).alias("avg_prep_time_sec"),
        F.max(prep).alias("max_prep_time_sec"),
    )
    return with_window_columns(
        breaches, *keys, "breach_count", "avg_prep_time_sec", "max_prep_time_sec"
    )


def weather_impact(orders: DataFrame, **timing: str) -> DataFrame:
    """Delivery times per weather; rating copies count as deliveries."""
    took = "actual_delivery_time_seconds"
    stats = per_window(timed_deliveries(orders), "weather_condition", **timing).agg(
        F.count("*").alias("order_count"),
        _mean_seconds(took).alias("avg_delivery_sec"),
        F.min(took).alias("min_delivery_sec"),
        F.max(took).alias("max_delivery_sec"),
        F.percentile_approx(took, 0.95).alias("p95_delivery_sec"),
    )
    return with_window_columns(
        stats,
        "weather_condition",
        "order_count",
        "avg_delivery_sec",
        "min_delivery_sec",
        "max_delivery_sec",
        "p95_delivery_sec",
    )


def processing_time(orders: DataFrame, **timing: str) -> DataFrame:
    """Preparation times per zone, taken when an order becomes ready."""
    prep = "actual_prep_time_seconds"
    stats = per_window(finished_preparations(orders), "zone_id", **timing).agg(
        F.count("*").alias("order_count"),
        _mean_seconds(prep).alias("avg_processing_sec"),
        F.min(prep).alias("min_processing_sec"),
        F.max(prep).alias("max_processing_sec"),
    )
    return with_window_columns(
        stats,
        "zone_id",
        "order_count",
        "avg_processing_sec",
        "min_processing_sec",
        "max_processing_sec",
    )


def order_value(orders: DataFrame, **timing: str) -> DataFrame:
    """Basket values and revenue per zone in euros, aggregated in cents."""
    cents = F.col("order_total_cents")
    sums = per_window(priced_placements(orders), "zone_id", **timing).agg(
        F.count("*").alias("order_count"),
        F.min(cents).alias("low"),
        F.max(cents).alias("high"),
        F.sum(cents).alias("revenue"),
    )
    mean = half_up_quotient(F.col("revenue"), F.col("order_count"))
    return with_window_columns(
        sums,
        "zone_id",
        "order_count",
        (mean / 100).alias("avg_order_eur"),
        (F.col("low") / 100).alias("min_order_eur"),
        (F.col("high") / 100).alias("max_order_eur"),
        (F.col("revenue") / 100).alias("total_revenue_eur"),
    )


def promised_eta(orders: DataFrame, **timing: str) -> DataFrame:
    """Delivery times promised at placement, per zone and weather."""
    eta = "estimated_delivery_time_seconds"
    keys = ("zone_id", "weather_condition")
    stats = per_window(promised_placements(orders), *keys, **timing).agg(
        F.count("*").alias("order_count"),
        _mean_seconds(eta).alias("avg_eta_sec"),
        F.min(eta).alias("min_eta_sec"),
        F.max(eta).alias("max_eta_sec"),
        F.percentile_approx(eta, 0.9).alias("p90_eta_sec"),
    )
    return with_window_columns(
        stats, *keys, "order_count", "avg_eta_sec", "min_eta_sec", "max_eta_sec", "p90_eta_sec"
    )
