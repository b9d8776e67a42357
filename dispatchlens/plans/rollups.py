"""Report roll-ups over the nine result tables.

Means follow the report they serve: some are plain means of window means,
others are weighted by the number of orders or sessions.  Rounding to a fixed
number of digits is half-even, as in the reports.  Rows with a null group key
belong to no group and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dimensions import VEHICLE_TYPES, WEATHER_CONDITIONS, ZONE_IDS
from ..functions.domain import ordinal
from ..functions.numbers import half_even, percent, scaled, weighted_mean

TYPED_ANOMALIES = ("impossible_speed", "location_jump", "offline_mid_delivery")


def within_dates(
    rows: DataFrame, first: str | None = None, last: str | None = None, column: str = "window_date"
) -> DataFrame:
    """Restrict a stored table by its partition column."""
    if first is not None:
        rows = rows.filter(F.col(column) >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.filter(F.col(column) <= F.lit(last).cast("date"))
    return rows


def _by(results: DataFrame, *keys: str):
    for key in keys:
        results = results.filter(F.col(key).isNotNull())
    return results.groupBy(*keys)


def _total(name: str) -> Column:
    return F.sum(name).alias(name)


def _sum_or_zero(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).alias(name)


def zones_at_hand(rows: DataFrame, most: int = 500) -> list[str]:
    """The listed zones, then those that the rows hold besides, by name; at most so many of the latter."""
    zone = F.col("zone_id")
    others = rows.filter(~zone.isin(*ZONE_IDS)).select(zone).distinct().orderBy(zone).limit(most)
    return [*ZONE_IDS, *(row.zone_id for row in others.collect())]


def _zone_means(name: str, zones: list[str]) -> list[Column]:
    """Mean of a column in each zone, and in all that are not listed together."""
    zone = F.col("zone_id")
    each = [F.avg(F.when(zone == z, F.col(name))).alias(z) for z in zones]
    return [*each, F.avg(F.when(~zone.isin(*ZONE_IDS), F.col(name))).alias("other_zones")]


# --- order volume ------------------------------------------------------------


def order_kpis(volume: DataFrame) -> DataFrame:
    rate = percent(F.col("cancelled_orders"), F.col("total_orders"))
    return order_parts(volume).withColumn("cancellation_rate_pct", rate)


def orders_by_zone(volume: DataFrame) -> DataFrame:
    return _by(volume, "zone_id").agg(_total("total_orders"), _total("cancelled_orders"))


def orders_over_time(volume: DataFrame) -> DataFrame:
    sums = _by(volume, "window_start").agg(_total("total_orders"), _total("cancelled_orders"))
    return sums.orderBy("window_start")


# --- order value -------------------------------------------------------------


def _revenue_cents() -> Column:
    return F.sum(scaled(F.col("total_revenue_eur")))


def revenue_parts(value: DataFrame) -> DataFrame:
    """Sums per zone that add up over any parts of the result table."""
    return _by(value, "zone_id").agg(
        _total("order_count"),
        F.sum(scaled(F.col("avg_order_eur"))).alias("mean_cents"),
        F.count("avg_order_eur").alias("windows"),
        _revenue_cents().alias("revenue_cents"),
    )


def revenue_from_parts(parts: DataFrame) -> DataFrame:
    """The mean over windows of their means, rounded to cents, and totals per zone."""
    return parts.select(
        "zone_id",
        "order_count",
        (F.rint(F.col("mean_cents") / F.col("windows")) / 100).alias("avg_order_eur"),
        (F.col("revenue_cents") / 100).alias("total_revenue_eur"),
    )


def revenue_by_zone(value: DataFrame) -> DataFrame:
    return revenue_from_parts(revenue_parts(value))


def order_parts(volume: DataFrame) -> DataFrame:
    """Sums that add up over any parts of the result table; no rows give one row of zeros."""
    return volume.agg(_sum_or_zero("total_orders"), _sum_or_zero("cancelled_orders"))


def revenue_kpis(value: DataFrame) -> DataFrame:
    """Totals, and the mean over zones of the rounded zone means."""
    return revenue_by_zone(value).agg(
        _total("order_count"),
        (F.sum(scaled(F.col("avg_order_eur"))) / F.count("avg_order_eur") / 100).alias(
            "avg_basket_eur"
        ),
        (_revenue_cents() / 100).alias("total_revenue_eur"),
    )


def cumulative_revenue(value: DataFrame) -> DataFrame:
    """Running revenue over all zones.

    The running sum stays inside a day; only one total per day goes through
    the single-task window that carries the sum from day to day.
    """
    minutes = _by(value, "window_date", "window_start").agg(_revenue_cents().alias("cents"))
    # the few rows of a day serve the sum, the running sum and the join from one distribution
    minutes = minutes.repartition("window_date")
    upto = Window.unboundedPreceding, Window.currentRow
    in_day = Window.partitionBy("window_date").orderBy("window_start").rowsBetween(*upto)
    days = (
        minutes.groupBy("window_date")
        .agg(F.sum("cents").alias("day_cents"))
        .withColumn(
            "carried",
            F.sum("day_cents").over(Window.orderBy("window_date").rowsBetween(*upto))
            - F.col("day_cents"),
        )
        .select("window_date", "carried")
    )
    return (
        minutes.withColumn("running", F.sum("cents").over(in_day))
        .join(days, "window_date")
        .select(
            "window_start",
            (F.col("cents") / 100).alias("revenue_eur"),
            ((F.col("running") + F.col("carried")) / 100).alias("cumulative_revenue_eur"),
        )
        .orderBy("window_start")
    )


# --- supply and demand -------------------------------------------------------


def supply_latest(balance: DataFrame) -> DataFrame:
    """The latest window of each zone."""
    latest = Window.partitionBy("zone_id").orderBy(F.desc("window_start"))
    return (
        balance.filter(F.col("zone_id").isNotNull())
        .withColumn("rank", F.row_number().over(latest))
        .filter(F.col("rank") == 1)
        .select("zone_id", "window_start", "demand_orders", "supply_couriers")
    )


def ratio_pivot(balance: DataFrame) -> DataFrame:
    """Mean demand/supply ratio, a column for each listed zone and each other one at hand, and one for
    all that are not listed together."""
    return (
        _by(balance, "window_start")
        .agg(*_zone_means("demand_supply_ratio", zones_at_hand(balance)))
        .orderBy("window_start")
    )


def last_window(balance: DataFrame) -> DataFrame:
    return balance.agg(F.max("window_end").alias("latest_window_end"))


# --- preparation -------------------------------------------------------------


def prep_by_zone(processing: DataFrame) -> DataFrame:
    return _by(processing, "zone_id").agg(
        _total("order_count"),
        half_even(F.avg("avg_processing_sec")).alias("avg_processing_sec"),
        F.max("max_processing_sec").alias("max_processing_sec"),
    )


def sla_kpis(breaches: DataFrame) -> DataFrame:
    return breaches.agg(
        F.sum("breach_count").alias("total_breaches"),
        F.avg("avg_prep_time_sec").alias("avg_prep_on_breach_sec"),
    )


def sla_peak_split(breaches: DataFrame) -> DataFrame:
    label = F.when(F.col("is_peak_hour"), "Peak hour").otherwise("Off-peak")
    sums = _by(breaches, "is_peak_hour").agg(_total("breach_count"))
    return sums.select(label.alias("period"), "breach_count")


def sla_over_time(breaches: DataFrame) -> DataFrame:
    return _by(breaches, "window_start").agg(_total("breach_count")).orderBy("window_start")


# --- weather and promises ----------------------------------------------------


def _weighted(name: str) -> Column:
    """Order-weighted mean of whole seconds, rounded to whole seconds."""
    return half_even(weighted_mean(F.col(name), F.col("order_count"))).alias(name)


def weather_summary(weather: DataFrame) -> DataFrame:
    """One row per weather in its fixed order; other values are left out."""
    return (
        _by(weather, "weather_condition")
        .agg(
            _total("order_count"), _weighted("avg_delivery_sec"), _weighted("p95_delivery_sec")
        )
        .filter(F.col("weather_condition").isin(*WEATHER_CONDITIONS))
        .orderBy(ordinal(F.col("weather_condition"), WEATHER_CONDITIONS))
    )


def _eta_by_zone_and_weather(promises: DataFrame) -> DataFrame:
    return _by(promises, "zone_id", "weather_condition").agg(
        _total("order_count"), _weighted("avg_eta_sec"), _weighted("p90_eta_sec")
    )


def _longest_first() -> list[Column | str]:
    return [F.desc("avg_eta_sec"), "zone_id", "weather_condition"]


def eta_summary(promises: DataFrame) -> DataFrame:
    return _eta_by_zone_and_weather(promises).orderBy(*_longest_first())


def eta_kpis(promises: DataFrame) -> DataFrame:
    return promises.agg(
        _total("order_count"), _weighted("avg_eta_sec"), _weighted("p90_eta_sec")
    )


def eta_pivot(promises: DataFrame) -> DataFrame:
    """Mean promise, weather by zone, in the fixed order of weather; zones as in ``ratio_pivot``."""
    zones = zones_at_hand(promises)
    return (
        _eta_by_zone_and_weather(promises)
        .filter(F.col("weather_condition").isin(*WEATHER_CONDITIONS))
        .groupBy("weather_condition")
        .agg(*_zone_means("avg_eta_sec", zones))
        .dropna("all", subset=[f"`{z}`" for z in zones] + ["other_zones"])
        .orderBy(ordinal(F.col("weather_condition"), WEATHER_CONDITIONS))
    )


def eta_top(promises: DataFrame, rows: int = 10) -> DataFrame:
    return _eta_by_zone_and_weather(promises).orderBy(*_longest_first()).limit(rows)


# --- anomalies ---------------------------------------------------------------


def anomaly_kpis(anomalies: DataFrame) -> DataFrame:
    sums = anomalies.agg(_sum_or_zero("total_events"), _sum_or_zero("total_anomalies"))
    rate = percent(F.col("total_anomalies"), F.col("total_events"))
    return sums.withColumn("anomaly_rate_pct", rate)


def anomaly_by_zone(anomalies: DataFrame) -> DataFrame:
    """Typed counters by zone; counters the table lacks are left out."""
    present = [name for name in TYPED_ANOMALIES if name in anomalies.columns]
    return _by(anomalies, "zone_id").agg(*[_total(name) for name in present])


def anomaly_rate_over_time(anomalies: DataFrame) -> DataFrame:
    sums = _by(anomalies, "window_start").agg(_total("total_events"), _total("total_anomalies"))
    rate = percent(F.col("total_anomalies"), F.col("total_events"))
    return sums.select("window_start", rate.alias("anomaly_rate_pct")).orderBy("window_start")


# --- productivity ------------------------------------------------------------


def _per_session(name: str) -> Column:
    """Session-weighted mean of values with two decimals, in hundredths."""
    return weighted_mean(scaled(F.col(name)), F.col("session_count"))


def productivity_rollup(productivity: DataFrame) -> DataFrame:
    return _by(productivity, "vehicle_type", "zone_id").agg(
        F.sum("session_count").alias("sessions"),
        (F.rint(_per_session("avg_deliveries")) / 100).alias("avg_deliveries"),
        half_even(F.median("p50_deliveries"), 1).alias("p50_deliveries"),
        half_even(F.median("p90_deliveries"), 1).alias("p90_deliveries"),
        (F.rint(_per_session("deliveries_per_hour")) / 100).alias("deliveries_per_hour"),
    )


def productivity_kpis(productivity: DataFrame) -> DataFrame:
    return productivity.agg(
        F.sum("session_count").alias("sessions"),
        (_per_session("avg_deliveries") / 100).alias("avg_deliveries"),
        (_per_session("deliveries_per_hour") / 100).alias("deliveries_per_hour"),
    )


def productivity_pivot(productivity: DataFrame) -> DataFrame:
    """Deliveries per hour, zone by vehicle."""
    return (
        productivity_rollup(productivity)
        .groupBy("zone_id")
        .pivot("vehicle_type", list(VEHICLE_TYPES))
        .agg(F.max("deliveries_per_hour"))
    )


def productivity_ranked(productivity: DataFrame) -> DataFrame:
    return productivity_rollup(productivity).orderBy(
        F.desc("deliveries_per_hour"), "vehicle_type", "zone_id"
    )
