"""Feed summaries and data-quality checks."""

from frames import couriers, orders

from dispatchlens import schemas
from dispatchlens.operators import quality as Q


def test_counts(spark):
    o = orders(spark, {}, {"is_duplicate": True}, {"order_status": "FAILED", "is_late_arrival": True})
    c = couriers(spark, {"anomaly_flag": "CLOCK_SKEW"}, {"is_duplicate": True})
    assert [tuple(r) for r in Q.status_counts(o).collect()] == [("FAILED", 1), ("PLACED", 2)]
    assert {r[0]: r[1] for r in Q.anomaly_counts(c).collect()} == {"CLOCK_SKEW": 1, None: 1}
    assert tuple(Q.edge_case_counts(o, c).first()) == (1, 1, 1, 0, 1, 5)


def test_timeline_is_sorted_by_ingestion(spark):
    o = orders(spark, {"t": 5, "lag_ms": 9000}, {"t": 6})
    c = couriers(spark, {"t": 10})
    assert [r.feed for r in Q.timeline(o, c).collect()] == ["orders", "couriers", "orders"]


def test_late_arrivals_keep_negative_lags_apart(spark):
    o = orders(
        spark,
        {"lag_ms": 30_000},
        {"lag_ms": 30_001, "is_late_arrival": True},
        {"lag_ms": -5000, "is_late_arrival": True},
    )
    row = Q.late_arrivals(o, couriers(spark)).first()
    assert (row.events, row.late_by_lag, row.late_by_flag, row.agreeing) == (3, 1, 2, 2)
    assert (row.negative_lag, row.avg_lag_ms, row.max_lag_ms, row.p95_lag_s) == (1, 30000.5, 30001, 30)


def test_dedup_keeps_the_first_ingested(spark):
    o = orders(
        spark,
        {"event_id": "x", "lag_ms": 900, "is_duplicate": True},
        *[{"event_id": "x", "lag_ms": 950, "is_duplicate": True}] * 300,
        {"event_id": "x", "lag_ms": 100},
        {"event_id": "y"},
    )
    found = {r.event_id: r.is_duplicate for r in Q.dedup_orders(o).collect()}
    assert found == {"x": False, "y": False}
    c = couriers(
        spark,
        {"lag_ms": 5},
        {"lag_ms": 9, "is_duplicate": True},
        {"t": 1},
        {"courier_status": "BREAK"},
    )
    kept = Q.dedup_couriers(c).collect()
    assert len(kept) == 3 and not any(r.is_duplicate for r in kept)


def test_enum_violations(spark):
    o = orders(
        spark, {"order_status": "LOST"}, {"weather_condition": "FOG", "previous_status": "NEW"}, {}
    )
    rows = Q.enum_violations(o, "orders", schemas.enum_columns(schemas.ORDER_FEED)).collect()
    assert {r.column_name: r.violations for r in rows} == {
        "order_status": 1,
        "previous_status": 1,
        "weather_condition": 1,
        "cancellation_reason": 0,
    }


def test_offline_mid_delivery(spark):
    flag = {"anomaly_flag": "OFFLINE_MID_DELIVERY"}
    c = couriers(
        spark,
        {"courier_status": "OFFLINE", "order_id": "o", **flag},
        {"courier_status": "OFFLINE", "order_id": "o"},
        {"courier_status": "OFFLINE"},
        {"courier_status": "BREAK", **flag},
    )
    row = Q.offline_mid_delivery(c).first()
    assert (row.detected, row.flagged, row.agreeing) == (2, 2, 1)
