"""Items, totals, ratings, cancellations and demand."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..dimensions import HOURLY_WEIGHT
from ..functions.domain import demand_weight, is_peak_hour, promised_delivery_seconds
from .orders import in_status, originals


def explode_items(orders: DataFrame) -> DataFrame:
    """One row per ordered item of the placed orders."""
    placed = in_status(orders, "PLACED", "order_items")
    return placed.select("order_id", F.inline("order_items"))


def item_sales(items: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Quantity and revenue per item; names are joined after aggregation."""
    sales = items.groupBy("item_id").agg(
        F.count("*").alias("order_lines"),
        F.sum("quantity").alias("quantity"),
        (F.sum(F.col("quantity").cast("bigint") * F.col("unit_price_cents")) / 100).alias(
            "revenue_eur"
        ),
    )
    return sales if names is None else sales.join(names, "item_id", "left")


def order_total_check(orders: DataFrame) -> DataFrame:
    """Stated order totals against the sum of the items in ``order_items``, per zone."""
    summed = F.aggregate(
        "order_items",
        F.lit(0).cast("bigint"),
        lambda total, item: total + item["quantity"] * item["unit_price_cents"],
    )
    total = F.col("order_total_cents")
    return (
        in_status(orders, "PLACED")
        .withColumn("item_cents", summed)
        .groupBy("zone_id")
        .agg(
            F.count("*").alias("orders"),
            F.count_if(total.isNull()).alias("without_total"),
            F.count_if(F.col("item_cents").isNull()).alias("without_items"),
            F.count_if(total == F.col("item_cents")).alias("matching"),
            F.count_if(total != F.col("item_cents")).alias("differing"),
        )
    )


def promise_formula_check(orders: DataFrame, tolerance_seconds: int = 0) -> DataFrame:
    """Recompute peak flag and promise of placed orders and count differences."""
    stated = F.col("estimated_delivery_time_seconds")
    formula = promised_delivery_seconds(
        F.col("estimated_prep_time_seconds"), F.col("weather_condition")
    )
    return (
        in_status(orders, "PLACED")
        .groupBy("zone_id")
        .agg(
            F.count("*").alias("placed"),
            F.count_if(is_peak_hour(F.col("event_timestamp")) != F.col("is_peak_hour")).alias(
                "peak_differs"
            ),
            F.count_if(F.abs(formula - stated) > tolerance_seconds).alias("promise_differs"),
            F.sum(stated - formula).alias("promise_drift_sec"),
        )
    )


def demand_curve(orders: DataFrame) -> DataFrame:
    """Placed orders per date and hour against the expected demand curve."""
    hourly = (
        in_status(orders, "PLACED")
        .groupBy(F.date_trunc("hour", "event_timestamp").alias("hour_start"))
        .agg(F.count("*").alias("orders"))
        .withColumn("order_date", F.to_date("hour_start"))
    )
    day = Window.partitionBy("order_date")
    weight = F.get(F.array(*[F.lit(w) for w in HOURLY_WEIGHT]), F.hour("hour_start"))
    return hourly.select(
        "order_date",
        F.hour("hour_start").alias("order_hour"),
        "orders",
        F.round(F.col("orders") / F.sum("orders").over(day), 4).alias("share"),
        F.round(demand_weight(F.col("hour_start")), 4).alias("demand_weight"),
        F.round(weight / sum(HOURLY_WEIGHT), 4).alias("expected_share"),
    )


def cancellation_reasons(orders: DataFrame) -> DataFrame:
    """Cancellations by zone and reason, with each reason's share of its zone."""
    counts = (
        in_status(orders, "CANCELLED")
        .groupBy("zone_id", "cancellation_reason")
        .agg(F.count("*").alias("cancellations"))
    )
    zone = F.sum("cancellations").over(Window.partitionBy("zone_id"))
    return counts.withColumn("share", F.round(F.col("cancellations") / zone, 4))


def restaurant_ratings(orders: DataFrame) -> DataFrame:
    """Mean customer rating per restaurant, summed in tenths of a point."""
    rated = originals(orders).filter(F.col("customer_rating").isNotNull())
    tenths = F.round(F.col("customer_rating") * 10).cast("bigint")
    return rated.groupBy("restaurant_id").agg(
        F.count("*").alias("ratings"),
        F.round(F.sum(tenths) / F.count("*") / 10, 3).alias("avg_rating"),
    )
