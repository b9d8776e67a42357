"""Demand against supply: the two feeds joined per window and zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dimensions import SURGE_RATIO
from ..functions.windows import per_window, with_window_columns
from .orders import originals, placements


def _demand(orders: DataFrame, **timing: str) -> DataFrame:
    placed = per_window(placements(orders), "zone_id", **timing)
    return placed.agg(F.count("*").alias("demand_orders"))


def idle_couriers(couriers: DataFrame) -> DataFrame:
    """Non-duplicate pings of couriers that wait for an order."""
    return originals(couriers).filter(F.col("courier_status") == "ONLINE_IDLE")


def _supply(couriers: DataFrame, exact: bool, **timing: str) -> DataFrame:
    """Idle couriers per window and zone.

    The exact count goes through one row per courier: unlike a distinct count
    it runs on streams, and a busy zone is spread over its couriers.
    """
    idle = idle_couriers(couriers)
    if not exact:
        return per_window(idle, "zone_id", **timing).agg(
            F.approx_count_distinct("courier_id").alias("supply_couriers")
        )
    each = per_window(idle, "zone_id", "courier_id", **timing).agg(F.count("*").alias("pings"))
    return each.groupBy("window", "zone_id").agg(
        F.count("courier_id").alias("supply_couriers")
    )


def supply_demand(
    orders: DataFrame,
    couriers: DataFrame,
    exact: bool = True,
    keep_unserved: bool = False,
    **timing: str,
) -> DataFrame:
    """Placed orders against idle couriers.

    By default only zones with both sides appear.  ``keep_unserved`` keeps the
    zones that have demand and no idle courier at all; their ratio is the
    demand itself.
    """
    demand = _demand(orders, **timing)
    supply = _supply(couriers, exact, **timing)
    joined = demand.join(supply, ["window", "zone_id"], "left" if keep_unserved else "inner")
    idle = F.coalesce(F.col("supply_couriers"), F.lit(0))
    load = F.round(F.col("demand_orders") / F.greatest(idle, F.lit(1)), 2)
    return with_window_columns(
        joined,
        "zone_id",
        "demand_orders",
        idle.alias("supply_couriers"),
        load.alias("demand_supply_ratio"),
    )


def supply_estimate_check(orders: DataFrame, couriers: DataFrame, error: float = 0.05) -> DataFrame:
    """The exact supply, and whether the sketch lies within three of its stated errors of it, or
    one courier where that is less."""
    exact = supply_demand(orders, couriers).drop("demand_supply_ratio")
    sketch = supply_demand(orders, couriers, exact=False).select(
        "window_start", "zone_id", F.col("supply_couriers").alias("estimate")
    )
    off = F.abs(F.col("estimate") - F.col("supply_couriers"))
    allowed = F.greatest(F.lit(1.0), 3 * error * F.col("supply_couriers"))
    joined = exact.join(sketch, ["window_start", "zone_id"], "left")
    return joined.withColumn("within_error", F.coalesce(off <= allowed, F.lit(False))).drop("estimate")


def surge_windows(supply_and_demand: DataFrame, threshold: float = SURGE_RATIO) -> DataFrame:
    """Windows in which demand exceeds supply by the threshold or more."""
    return supply_and_demand.filter(F.col("demand_supply_ratio") >= threshold)
