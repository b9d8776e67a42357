"""Ratios, roundings and sums on awkward values."""

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dispatchlens.functions import numbers as N
from dispatchlens.plans.catalog import ANALYTICS
from oracle import feeds as fixture


def column(spark, values, ddl="v double"):
    return spark.createDataFrame([(v,) for v in values], ddl)


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_half_even_is_numpy_round(spark, digits):
    rng = np.random.default_rng(1)
    ties = np.arange(-40, 40) / 8
    values = np.concatenate([ties, rng.normal(0, 1000, 500)]).tolist()
    frame = column(spark, values).select(N.half_even(F.col("v"), digits))
    assert [r[0] for r in frame.collect()] == np.round(values, digits).tolist()


def test_scaled_recovers_hundredths(spark):
    whole = list(range(0, 40_000, 7))
    frame = column(spark, [v / 100 for v in whole]).select(N.scaled(F.col("v")))
    assert [r[0] for r in frame.collect()] == whole


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**52), st.integers(1, 2**40)), min_size=1, max_size=50))
def test_half_up_quotient(spark, pairs):
    frame = spark.createDataFrame(pairs, "t long, n long")
    found = [r[0] for r in frame.select(N.half_up_quotient(F.col("t"), F.col("n"))).collect()]
    want = [int((Decimal(t) / n).quantize(Decimal(1), ROUND_HALF_UP)) for t, n in pairs]
    assert found == want


def test_guards(spark):
    frame = spark.createDataFrame([(1, 0), (1, 4)], "a long, b long")
    assert [r[0] for r in frame.select(N.ratio(F.col("a"), F.col("b"))).collect()] == [0.0, 0.25]
    assert [r[0] for r in frame.select(N.percent(F.col("a"), F.col("b"))).collect()] == [0.0, 25.0]


def test_results_do_not_depend_on_the_layout(spark, tables):
    """The same amounts from one partition and from many, in any order."""
    feed = fixture.order_feed(spark, tables)
    value = ANALYTICS["uc11_order_value"]
    one = value({"orders": feed.coalesce(1)})
    many = value({"orders": feed.repartition(13, F.rand(5))})
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
