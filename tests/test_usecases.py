"""Semantics of the nine analytics on hand-made feeds."""

from frames import at, couriers, orders

from dispatchlens.operators import couriers as C
from dispatchlens.operators import market as M
from dispatchlens.operators import orders as O


def only(frame):
    rows = frame.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_rate_is_zero_without_placements(spark):
    row = only(O.order_volume(orders(spark, {"order_status": "CANCELLED"})))
    assert (row.total_orders, row.cancelled_orders, row.cancellation_rate) == (0, 1, 0.0)


def test_rate_may_pass_one_hundred(spark):
    feed = orders(spark, {}, *[{"order_status": "CANCELLED"}] * 3)
    assert only(O.order_volume(feed)).cancellation_rate == 300.0


def test_null_or_true_duplicate_flag_never_counts(spark):
    feed = orders(spark, {}, {"is_duplicate": None}, {"is_duplicate": True})
    assert only(O.order_volume(feed)).total_orders == 1


def test_event_on_the_edge_belongs_to_the_later_window(spark):
    feed = orders(spark, {"t": 59}, {"t": 60})
    starts = [r.window_start for r in O.order_volume(feed).orderBy("window_start").collect()]
    assert starts == [at(0), at(60)]


def test_window_length_is_a_parameter(spark):
    feed = orders(spark, {"t": 59}, {"t": 60})
    assert only(O.order_volume(feed, window="5 minutes")).total_orders == 2


def ready(seconds, **more):
    return {"order_status": "READY_FOR_PICKUP", "actual_prep_time_seconds": seconds, **more}


def test_prep_limit_is_strict(spark):
    feed = orders(spark, ready(1200), ready(1201), ready(None), ready(1500, order_status="DELIVERED"))
    row = only(O.prep_sla_breaches(feed))
    assert (row.breach_count, row.avg_prep_time_sec, row.max_prep_time_sec) == (1, 1201.0, 1201)
    assert only(O.prep_sla_breaches(feed, limit_seconds=1199)).breach_count == 2


def test_processing_time_reads_only_the_ready_event(spark):
    feed = orders(spark, ready(100), ready(105), ready(900, order_status="PICKED_UP"))
    row = only(O.processing_time(feed))
    assert (row.order_count, row.avg_processing_sec, row.max_processing_sec) == (2, 103.0, 105)


def test_weather_counts_rating_copies(spark):
    done = {"order_status": "DELIVERED", "actual_delivery_time_seconds": 1000}
    feed = orders(spark, done, {**done, "customer_rating": 4.5, "t": 30})
    row = only(O.weather_impact(feed))
    assert row.order_count == 2
    assert row.p95_delivery_sec == 1000
    assert dict(O.weather_impact(feed).dtypes)["p95_delivery_sec"] == "int"


def test_order_value_rounds_half_cents_up(spark):
    feed = orders(
        spark,
        {"order_total_cents": 100},
        {"order_total_cents": 101},
        {"order_total_cents": None},
        {"order_total_cents": 999, "order_status": "ACCEPTED"},
    )
    row = only(O.order_value(feed))
    assert row.order_count == 2
    assert (row.avg_order_eur, row.min_order_eur, row.max_order_eur) == (1.01, 1.0, 1.01)
    assert row.total_revenue_eur == 2.01


def test_promised_eta_percentile(spark):
    feed = orders(spark, *[{"estimated_delivery_time_seconds": s} for s in range(1, 11)])
    row = only(O.promised_eta(feed))
    assert (row.avg_eta_sec, row.min_eta_sec, row.max_eta_sec, row.p90_eta_sec) == (6.0, 1, 10, 9)


def test_anomaly_total_counts_every_flag_and_duplicates(spark):
    flags = ["CLOCK_SKEW", "DUPLICATE_PING", "LOCATION_JUMP", "IMPOSSIBLE_SPEED"]
    feed = couriers(
        spark,
        *[{"anomaly_flag": f} for f in flags],
        {"anomaly_flag": "OFFLINE_MID_DELIVERY", "is_duplicate": True},
        {},
    )
    row = only(C.anomalies(feed))
    assert (row.total_events, row.total_anomalies, row.anomaly_rate) == (6, 5, 83.33)
    assert (row.impossible_speed, row.location_jump, row.offline_mid_delivery) == (1, 1, 1)


def test_supply_counts_couriers_not_pings(spark):
    feed = couriers(spark, {}, {"t": 5}, {"courier_id": "courier_2"}, {"courier_status": "BREAK"})
    placed = orders(spark, {}, {}, {})
    for exact in (True, False):
        row = only(M.supply_demand(placed, feed, exact=exact))
        assert (row.demand_orders, row.supply_couriers, row.demand_supply_ratio) == (3, 2, 1.5)


def test_zone_without_idle_couriers(spark):
    placed = orders(spark, {}, {}, {"zone_id": "zone_east"})
    idle = couriers(spark, {"zone_id": "zone_east"})
    assert only(M.supply_demand(placed, idle)).zone_id == "zone_east"
    kept = M.supply_demand(placed, idle, keep_unserved=True)
    west = only(kept.filter("zone_id = 'zone_west'"))
    assert (west.supply_couriers, west.demand_supply_ratio) == (0, 2.0)


def test_surge_threshold_is_inclusive(spark):
    balance = M.supply_demand(orders(spark, {}, {}, {}), couriers(spark, {}))
    assert M.surge_windows(balance).count() == 1
    assert M.surge_windows(balance, 3.01).count() == 0


def test_session_counts_in_every_window_it_touches(spark):
    feed = couriers(
        spark,
        {"t": 0, "deliveries_completed_in_session": 1, "shift_duration_seconds": 600},
        {"t": 30, "deliveries_completed_in_session": 2, "shift_duration_seconds": 1800},
        {"t": 61, "deliveries_completed_in_session": 3, "shift_duration_seconds": 3600},
        {"t": 62, "shift_duration_seconds": None, "session_id": "sess_2"},
    )
    first, second = C.courier_productivity(feed).orderBy("window_start").collect()
    assert (first.session_count, first.avg_deliveries, first.deliveries_per_hour) == (1, 2.0, 4.0)
    assert (second.session_count, second.p50_deliveries, second.avg_shift_minutes) == (1, 3, 60.0)


def test_no_shift_time_gives_zero_per_hour(spark):
    row = only(C.courier_productivity(couriers(spark, {"shift_duration_seconds": 0})))
    assert row.deliveries_per_hour == 0.0
