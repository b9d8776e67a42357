"""Windowed analytics over the courier feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent, ratio
from ..functions.windows import per_window, with_window_columns
from .orders import originals


def all_pings(couriers: DataFrame) -> DataFrame:
    """Every ping, duplicates among them."""
    return couriers


def anomalies(couriers: DataFrame, **timing: str) -> DataFrame:
    """Flagged pings per zone and vehicle.

    Duplicates stay in, and the total counts every flag, also those without a
    column of their own.
    """
    flag = F.col("anomaly_flag")
    keys = ("zone_id", "vehicle_type")
    counts = per_window(all_pings(couriers), *keys, **timing).agg(
        F.count("*").alias("total_events"),
        F.count(flag).alias("total_anomalies"),
        F.count_if(flag == "IMPOSSIBLE_SPEED").alias("impossible_speed"),
        F.count_if(flag == "LOCATION_JUMP").alias("location_jump"),
        F.count_if(flag == "OFFLINE_MID_DELIVERY").alias("offline_mid_delivery"),
    )
    rate = F.round(percent(F.col("total_anomalies"), F.col("total_events")), 2)
    return with_window_columns(
        counts,
        *keys,
        "total_events",
        "total_anomalies",
        rate.alias("anomaly_rate"),
        "impossible_speed",
        "location_jump",
        "offline_mid_delivery",
    )


def active_couriers(couriers: DataFrame) -> DataFrame:
    """Non-duplicate pings with both counters of their session."""
    return originals(couriers).filter(
        F.col("shift_duration_seconds").isNotNull()
        & F.col("deliveries_completed_in_session").isNotNull()
    )


def session_finals(couriers: DataFrame, **timing: str) -> DataFrame:
    """The last counters of each session within a window; a session counts once in every window it
    touches."""
    keys = ("zone_id", "vehicle_type", "session_id")
    return per_window(active_couriers(couriers), *keys, **timing).agg(
        F.max("deliveries_completed_in_session").alias("deliveries"),
        F.max("shift_duration_seconds").alias("shift_seconds"),
    )


def courier_productivity(couriers: DataFrame, **timing: str) -> DataFrame:
    """Deliveries and shift time per vehicle and zone, over the last counters of sessions."""
    stats = session_finals(couriers, **timing).groupBy("window", "zone_id", "vehicle_type").agg(
        F.count("*").alias("session_count"),
        F.round(F.avg("deliveries"), 2).alias("avg_deliveries"),
        F.percentile_approx("deliveries", 0.5).alias("p50_deliveries"),
        F.percentile_approx("deliveries", 0.9).alias("p90_deliveries"),
        F.round(F.avg("shift_seconds") / 60, 1).alias("avg_shift_minutes"),
        F.sum("deliveries").alias("all_deliveries"),
        F.sum("shift_seconds").alias("all_seconds"),
    )
    per_hour = F.round(ratio(F.col("all_deliveries") * 3600, F.col("all_seconds")), 2)
    return with_window_columns(
        stats,
        "zone_id",
        "vehicle_type",
        "session_count",
        "avg_deliveries",
        "p50_deliveries",
        "p90_deliveries",
        "avg_shift_minutes",
        per_hour.alias("deliveries_per_hour"),
    )
