"""Expressions that encode rules of the delivery platform."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dimensions as dim


def lookup(key: Column, table: Mapping[str, int | float]) -> Column:
    """Constant lookup table as a CASE expression; null for an unknown key."""
    result = None
    for name, value in table.items():
        match = key == name
        result = F.when(match, value) if result is None else result.when(match, value)
    return result


def ordinal(key: Column, categories: tuple[str, ...]) -> Column:
    """Position of a category in its fixed order; null outside of it."""
    return lookup(key, {name: i for i, name in enumerate(categories)})


def is_peak_hour(timestamp: Column) -> Column:
    return F.hour(timestamp).isin(*dim.PEAK_HOURS)


def weather_percent(weather: Column) -> Column:
    return F.coalesce(lookup(weather, dim.WEATHER_PERCENT), F.lit(100))


def promised_delivery_seconds(prep_seconds: Column, weather: Column) -> Column:
    """Delivery promise: preparation plus handover, stretched by the weather."""
    stretched = (prep_seconds + dim.HANDOVER_SECONDS) * weather_percent(weather)
    return F.floor(stretched / 100).cast("int")


def demand_weight(timestamp: Column) -> Column:
    """Expected relative demand at a time: hour weight, raised on weekends."""
    by_hour = F.get(F.array(*[F.lit(w) for w in dim.HOURLY_WEIGHT]), F.hour(timestamp))
    weekend = F.dayofweek(timestamp).isin(1, 7)
    return by_hour * F.when(weekend, dim.WEEKEND_PERCENT).otherwise(100) / 10_000


def lag_millis(ingested: Column, happened: Column) -> Column:
    return F.unix_millis(ingested) - F.unix_millis(happened)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance between two points given in degrees."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2.0) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_lon), 2.0)
    return 2 * dim.EARTH_RADIUS_KM * F.asin(F.sqrt(chord))


def zone_at(lat: Column, lon: Column) -> Column:
    """Zone whose half-open box holds the point; null outside of all boxes."""
    boxes = [
        F.when(
            (lat >= z.lat_lo) & (lat < z.lat_hi) & (lon >= z.lon_lo) & (lon < z.lon_hi),
            z.zone_id,
        )
        for z in dim.ZONES
    ]
    return F.coalesce(*boxes)
