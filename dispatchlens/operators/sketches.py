"""Windowed results that can be merged: sketches of quantiles and of distinct values.

A percentile or a distinct count of one window says little about an hour: means of percentiles are none,
and couriers counted per minute cannot be added up.  These analytics keep a sketch per window and
key instead, a few kilobytes however many events it stands for.  Sketches of any windows, zones
or days merge to that of all their events, so stored windows answer for any stretch of time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import per_window, with_window_columns
from .couriers import session_finals
from .market import idle_couriers
from .orders import in_status

#: size of a quantile sketch; larger ones are more exact
QUANTILE_SIZE = 400
#: logarithm of the size of a distinct-count sketch
DISTINCT_BITS = 12


def quantile_sketch(name: str, size: int = QUANTILE_SIZE) -> Column:
    return F.kll_sketch_agg_bigint(F.col(name).cast("bigint"), size)


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """How far, as a share of all values, the rank of a told quantile may be off (99 of 100 times)."""
    return 2.296 / size**0.9723


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Standard error of a distinct count, as a share of it."""
    return 1.04 / 2 ** (bits / 2)


def delivery_sketches(orders: DataFrame, **timing: str) -> DataFrame:
    """Delivery times per weather, to be merged."""
    took = "actual_delivery_time_seconds"
    found = per_window(in_status(orders, "DELIVERED", took), "weather_condition", **timing).agg(
        F.count("*").alias("value_count"), quantile_sketch(took).alias("sketch")
    )
    return with_window_columns(found, "weather_condition", "value_count", "sketch")


def promise_sketches(orders: DataFrame, **timing: str) -> DataFrame:
    """Promised delivery times per zone and weather, to be merged."""
    eta, keys = "estimated_delivery_time_seconds", ("zone_id", "weather_condition")
    found = per_window(in_status(orders, "PLACED", eta), *keys, **timing).agg(
        F.count("*").alias("value_count"), quantile_sketch(eta).alias("sketch")
    )
    return with_window_columns(found, *keys, "value_count", "sketch")


def productivity_sketches(couriers: DataFrame, **timing: str) -> DataFrame:
    """Deliveries of sessions per zone and vehicle, to be merged."""
    keys = ("zone_id", "vehicle_type")
    found = session_finals(couriers, **timing).groupBy("window", *keys).agg(
        F.count("*").alias("value_count"), quantile_sketch("deliveries").alias("sketch")
    )
    return with_window_columns(found, *keys, "value_count", "sketch")


def idle_sketches(couriers: DataFrame, **timing: str) -> DataFrame:
    """Idle couriers per zone, to be united."""
    found = per_window(idle_couriers(couriers), "zone_id", **timing).agg(
        F.hll_sketch_agg("courier_id", DISTINCT_BITS).alias("sketch")
    )
    return with_window_columns(found, "zone_id", "sketch")


def merged_quantiles(sketches: DataFrame, shares: list[float], *keys: str) -> DataFrame:
    """Quantiles of all values behind the sketches of each key: a column ``quantiles`` of one value per
    share, and how many values there are."""
    merged = sketches.groupBy(*keys).agg(
        F.sum("value_count").alias("value_count"), F.kll_merge_agg_bigint("sketch").alias("sketch")
    )
    told = F.kll_sketch_get_quantile_bigint("sketch", F.array(*map(F.lit, shares)))
    return merged.select(*keys, "value_count", told.alias("quantiles"))


def united_counts(sketches: DataFrame, *keys: str | Column) -> DataFrame:
    """Distinct values behind the sketches of each key, as a column ``estimate``."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def quantile_check(
    told: DataFrame, values: DataFrame, value: str, shares: dict[str, float], *keys: str
) -> DataFrame:
    """Merged quantiles against the exact ones: a row per key and share, with the exact quantile and
    whether the told one's rank lies within three times the stated error.

    Values are counted first, so that a key's rows are its different values, not its events.
    ``shares`` are named, in the order of the told quantiles, in whole percents.
    """
    ordered = Window.partitionBy(*keys).orderBy(value)
    counted = (
        values.groupBy(*keys, value)
        .agg(F.count("*").alias("n"))
        .withColumns(
            {
                "upto": F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
                "total": F.sum("n").over(Window.partitionBy(*keys)),
            }
        )
    )
    each = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(name).alias("percentile"),
                    F.lit(round(100 * share)).alias("percent"),
                    F.col("quantiles")[i].alias("told"),
                )
                for i, (name, share) in enumerate(shares.items())
            )
        )
    )
    asked = told.select(*keys, F.col("value_count").alias("told_count"), each.alias("q")).select(
        *keys, "told_count", "q.*"
    )
    enough = F.col("upto") * 100 >= F.col("percent") * F.col("total")
    joined = counted.join(asked, list(keys))
    ranks = joined.groupBy(*keys, "percentile", "percent", "told_count").agg(
        F.max("total").alias("value_count"),
        F.min(F.when(enough, F.col(value))).cast("bigint").alias("exact_value"),
        F.max(F.when(F.col(value) < F.col("told"), F.col("upto"))).alias("below"),
        F.max(F.when(F.col(value) <= F.col("told"), F.col("upto"))).alias("upto"),
    )
    low = F.coalesce(F.col("below"), F.lit(0)) / F.col("value_count")
    high = F.coalesce(F.col("upto"), F.lit(0)) / F.col("value_count")
    share, error = F.col("percent") / 100, F.lit(3 * rank_error())
    within = (low - error <= share) & (share <= high + error) & (F.col("told_count") == F.col("value_count"))
    return ranks.select(*keys, "percentile", "value_count", "exact_value", within.alias("within_error"))


def distinct_check(told: DataFrame, exact: DataFrame, *keys: str, name: str) -> DataFrame:
    """Exact distinct counts, the column ``name``, and whether the told one lies within three of its
    stated errors of it, or one where that is less."""
    off = F.abs(F.col("estimate") - F.col(name))
    allowed = F.greatest(F.lit(1.0), 3 * distinct_error() * F.col(name))
    joined = exact.join(told, list(keys), "left")
    return joined.select(*keys, name, F.coalesce(off <= allowed, F.lit(False)).alias("within_error"))
