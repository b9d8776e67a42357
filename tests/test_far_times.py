"""Feeds whose days grow far beyond those of the small tables, and rows without a time."""

import pytest

import __spark_entry__ as entry
from dispatchlens.plans.catalog import ANALYTICS
from dispatchlens.session import new_run_folder
from dispatchlens.streaming.replay import Replay
from oracle import feeds as fixture

#: event days in 2024, 2101 and 2243
KEYS = [k + base for base in (1, 140_000_000, 400_000_000) for k in range(40)]
EVENTS = [k + base for base in (1, 95_000_000, 267_000_000) for k in range(40)]


@pytest.fixture(scope="module")
def far(spark):
    base = new_run_folder(spark, "far")
    kinds = "view", "click", "signup", "error", "purchase"
    rows = {
        "orders": [(k, k % 99, f"{1 + (k or 0) % 5}-X") if k else (k, 1, "1-X") for k in [*KEYS, None]],
        "events": [(e, e % 99, kinds[e % 5]) if e else (e, 1, "view") for e in [*EVENTS, None]],
    }
    for name, values in rows.items():
        frame = spark.createDataFrame(values, fixture.TABLES[name])
        frame.write.parquet(f"{base}/{name}.parquet")
    return base


def same(left, right):
    assert left.columns == right.columns
    assert left.count() == right.count()
    assert left.exceptAll(right).count() == 0


@pytest.mark.parametrize("name", ["orders", "couriers"])
def test_stored_feeds_keep_every_row(spark, far, name):
    columns = entry.ORDER_COLUMNS if name == "orders" else entry.COURIER_COLUMNS
    direct = fixture.feeds(spark, far)[name].select(*columns)
    assert direct.where("event_timestamp > '2200-01-01'").count() > 0
    # an order without a key has no events, a ping without one has no time
    assert direct.where("event_timestamp IS NULL").count() == (name == "couriers")
    same(entry.queries()["feed_" + name](spark, far), direct)


def test_results_keep_every_date(spark, far):
    direct = ANALYTICS["uc1_order_volume"](fixture.feeds(spark, far))
    assert direct.where("window_date > '2200-01-01'").count() > 0
    same(entry.queries()["io_results_roundtrip"](spark, far), direct)


@pytest.mark.parametrize("name", ["uc1_order_volume", "uc9_supply_demand"])
def test_flush_closes_the_last_windows(spark, far, name):
    feeds = fixture.feeds(spark, far)
    same(Replay(spark, feeds).analytic(name), ANALYTICS[name](feeds))


def test_one_feed_ends_long_before_the_other(spark, far):
    feeds = fixture.feeds(spark, far)
    feeds["couriers"] = feeds["couriers"].where("event_timestamp < '2100-01-01'")
    name = "uc9_supply_demand"
    same(Replay(spark, feeds).analytic(name), ANALYTICS[name](feeds))
