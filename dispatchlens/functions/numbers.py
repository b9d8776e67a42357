"""Ratios, roundings and exact sums.

Amounts with a fixed number of decimals are summed as scaled integers: a sum of
doubles depends on the order in which partial results meet, a sum of bigints
does not, so results repeat on any cluster layout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, 0.0 where the denominator is zero."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def percent(numerator: Column, denominator: Column) -> Column:
    """Unrounded percentage, 0.0 where the denominator is zero."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator * 100)


def half_even(value: Column, digits: int = 0) -> Column:
    """Round a double the way numpy and pandas do (ties to the even digit)."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale if digits else F.rint(value)


def scaled(value: Column, digits: int = 2) -> Column:
    """A double that carries ``digits`` decimals as an exact bigint."""
    return F.round(value * float(10**digits)).cast("bigint")


def weighted_mean(value: Column, weight: Column) -> Column:
    """Weighted mean of integer values (an aggregate), 0.0 for no weight."""
    return ratio(F.sum(value * weight), F.sum(weight))


def half_up_quotient(total: Column, count: Column) -> Column:
    """total / count rounded half up to an integer, for non-negative bigints."""
    return F.call_function("div", 2 * total + count, 2 * count)


def exact_percentile(name: str, share: float) -> Column:
    """Exact discrete percentile of whole seconds (an aggregate).

    Its state is one counter per distinct value, so it suits columns with few
    values next to their rows.
    """
    return F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY {name})")
