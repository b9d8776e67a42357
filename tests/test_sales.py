"""Items, totals, ratings, cancellations and demand."""

import pytest
from frames import orders

from dispatchlens.operators import sales as S


def item(name, quantity, price):
    return {"item_id": name, "item_name": name, "quantity": quantity, "unit_price_cents": price}


def with_items(spark):
    return orders(
        spark,
        {"order_id": "a", "order_items": [item("x", 2, 150), item("y", 1, 99)], "order_total_cents": 399},
        {"order_id": "b", "order_items": [item("x", 1, 150)], "order_total_cents": 151},
        {"order_id": "c"},
        {"order_id": "b", "order_items": [item("x", 1, 150)], "is_duplicate": True},
        {"order_id": "a", "order_status": "ACCEPTED"},
    )


def test_item_sales(spark):
    items = S.explode_items(with_items(spark))
    sold = {r.item_id: (r.order_lines, r.quantity, r.revenue_eur) for r in S.item_sales(items).collect()}
    assert sold == {"x": (2, 3, 4.5), "y": (1, 1, 0.99)}


def test_totals_check_embedded_and_exploded(spark):
    feed = with_items(spark)
    want = {"orders": 3, "without_total": 1, "without_items": 1, "matching": 1, "differing": 1}
    for check in (S.order_total_check(feed),):
        row = check.first().asDict()
        assert {k: row[k] for k in want} == want


def test_promise_formula(spark):
    base = {"estimated_prep_time_seconds": 1000, "weather_condition": "SNOW"}
    feed = orders(
        spark,
        {**base, "estimated_delivery_time_seconds": 3040},
        {**base, "estimated_delivery_time_seconds": 3041},
        {**base, "estimated_delivery_time_seconds": 3100, "is_peak_hour": False},
    )
    row = S.promise_formula_check(feed).first()
    assert (row.placed, row.peak_differs, row.promise_differs, row.promise_drift_sec) == (3, 1, 2, 61)
    assert S.promise_formula_check(feed, tolerance_seconds=1).first().promise_differs == 1


def test_demand_curve(spark):
    feed = orders(spark, {}, {}, {"t": 3600}, {"t": 5 * 86400}, {"order_status": "ACCEPTED"})
    rows = {(str(r.order_date), r.order_hour): r for r in S.demand_curve(feed).collect()}
    noon = rows["2024-01-01", 12]
    assert (noon.orders, noon.share, noon.demand_weight) == (2, 0.6667, 1.8)
    saturday = rows["2024-01-06", 12]
    assert (saturday.share, saturday.demand_weight) == (1.0, 2.25)
    assert saturday.expected_share == noon.expected_share == round(180 / 1902, 4)


def test_cancellation_shares(spark):
    gone = {"order_status": "CANCELLED"}
    feed = orders(
        spark,
        *[{**gone, "cancellation_reason": "PAYMENT_FAILED"}] * 3,
        {**gone, "cancellation_reason": "SYSTEM_ERROR"},
    )
    shares = {r.cancellation_reason: r.share for r in S.cancellation_reasons(feed).collect()}
    assert shares == {"PAYMENT_FAILED": 0.75, "SYSTEM_ERROR": 0.25}


def test_ratings(spark):
    feed = orders(spark, {"customer_rating": 4.1}, {"customer_rating": 4.2}, {})
    row = S.restaurant_ratings(feed).first()
    assert row.ratings == 2 and row.avg_rating == pytest.approx(4.15)
