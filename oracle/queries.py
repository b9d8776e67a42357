"""One SQL statement per registered query, returning the same columns."""

from __future__ import annotations

from .views import bigint, rounded, statement

_ZONES = (
    "zone_downtown",
    "zone_midtown",
    "zone_west",
    "zone_east",
    "zone_uptown",
    "zone_suburbs",
)
_VEHICLES = ("BICYCLE", "SCOOTER", "MOTORCYCLE", "CAR", "FOOT")
_WEATHER = "('CLEAR', 'RAIN', 'HEAVY_RAIN', 'SNOW')"

ANALYTICS = (
    "uc1_order_volume",
    "uc3_prep_sla",
    "uc4_weather",
    "uc7_anomalies",
    "uc9_supply_demand",
    "uc10_processing_time",
    "uc11_order_value",
    "uc12_eta_accuracy",
    "uc13_courier_productivity",
)

ORACLES: dict[str, str] = {name: statement(f"SELECT * FROM {name}", name) for name in ANALYTICS}
ORACLES |= {
    "stream_" + name.split("_")[0]: statement(f"SELECT * FROM {name}", name) for name in ANALYTICS
}


def _oracle(name: str, query: str, *needs: str) -> None:
    ORACLES[name] = statement(query, *needs)


def _sum(*names: str) -> str:
    return ", ".join(f"{bigint(f'sum({n})')} AS {n}" for n in names)


def _percent(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0.0 ELSE {part} / {whole} * 100 END"


def _cents(name: str) -> str:
    return f"cast(round({name} * 100) AS bigint)"


# --- reports -----------------------------------------------------------------

_oracle(
    "dash_order_kpis",
    f"""SELECT *, {_percent("cancelled_orders", "total_orders")} AS cancellation_rate_pct
FROM (SELECT {_sum("total_orders", "cancelled_orders")} FROM uc1_order_volume)""",
    "uc1_order_volume",
)
_oracle(
    "dash_orders_by_zone",
    f"""SELECT zone_id, {_sum("total_orders", "cancelled_orders")}
FROM uc1_order_volume GROUP BY zone_id""",
    "uc1_order_volume",
)
_oracle(
    "dash_orders_over_time",
    f"""SELECT window_start, {_sum("total_orders", "cancelled_orders")}
FROM uc1_order_volume GROUP BY window_start ORDER BY window_start""",
    "uc1_order_volume",
)

_BY_ZONE = f"""SELECT zone_id, {_sum("order_count")},
    round_even(sum({_cents("avg_order_eur")}) / count(*), 0) / 100 AS avg_order_eur,
    sum({_cents("total_revenue_eur")}) / 100 AS total_revenue_eur
FROM uc11_order_value GROUP BY zone_id"""

_oracle("dash_revenue_by_zone", _BY_ZONE, "uc11_order_value")
_oracle(
    "dash_revenue_kpis",
    f"""SELECT {_sum("order_count")},
    sum({_cents("avg_order_eur")}) / count(*) / 100 AS avg_basket_eur,
    sum({_cents("total_revenue_eur")}) / 100 AS total_revenue_eur
FROM ({_BY_ZONE})""",
    "uc11_order_value",
)
_oracle(
    "dash_cumulative_revenue",
    f"""SELECT window_start, cents / 100 AS revenue_eur,
    sum(cents) OVER (ORDER BY window_start ROWS UNBOUNDED PRECEDING) / 100
        AS cumulative_revenue_eur
FROM (SELECT window_start, sum({_cents("total_revenue_eur")}) AS cents
    FROM uc11_order_value GROUP BY window_start)
ORDER BY window_start""",
    "uc11_order_value",
)
_oracle(
    "dash_supply_latest",
    """SELECT zone_id, window_start, demand_orders, supply_couriers FROM uc9_supply_demand
QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY window_start DESC) = 1""",
    "uc9_supply_demand",
)
_oracle(
    "dash_ratio_pivot",
    "SELECT window_start, "
    + ", ".join(
        f"avg(demand_supply_ratio) FILTER (WHERE zone_id = '{z}') AS {z}" for z in (*_ZONES, "zone_airport")
    )
    + f", avg(demand_supply_ratio) FILTER (WHERE zone_id NOT IN {_ZONES}) AS other_zones"
    " FROM uc9_supply_demand GROUP BY window_start ORDER BY window_start",
    "uc9_supply_demand",
)
_oracle(
    "dash_supply_last_window",
    "SELECT max(window_end) AS latest_window_end FROM uc9_supply_demand",
    "uc9_supply_demand",
)
_oracle(
    "dash_prep_by_zone",
    f"""SELECT zone_id, {_sum("order_count")},
    round_even(avg(avg_processing_sec), 0) AS avg_processing_sec,
    max(max_processing_sec) AS max_processing_sec
FROM uc10_processing_time GROUP BY zone_id""",
    "uc10_processing_time",
)
_oracle(
    "dash_sla_kpis",
    f"""SELECT {bigint("sum(breach_count)")} AS total_breaches,
    avg(avg_prep_time_sec) AS avg_prep_on_breach_sec FROM uc3_prep_sla""",
    "uc3_prep_sla",
)
_oracle(
    "dash_sla_peak_split",
    f"""SELECT CASE WHEN is_peak_hour THEN 'Peak hour' ELSE 'Off-peak' END AS period,
    {_sum("breach_count")} FROM uc3_prep_sla GROUP BY is_peak_hour""",
    "uc3_prep_sla",
)
_oracle(
    "dash_sla_over_time",
    f"""SELECT window_start, {_sum("breach_count")}
FROM uc3_prep_sla GROUP BY window_start ORDER BY window_start""",
    "uc3_prep_sla",
)


def _weighted(name: str) -> str:
    return f"round_even(sum({name} * order_count) / sum(order_count), 0) AS {name}"


_oracle(
    "dash_weather_summary",
    f"""SELECT weather_condition, {_sum("order_count")}, {_weighted("avg_delivery_sec")},
    {_weighted("p95_delivery_sec")}
FROM uc4_weather WHERE weather_condition IN {_WEATHER} GROUP BY weather_condition""",
    "uc4_weather",
)

_ETA = f"""SELECT zone_id, weather_condition, {_sum("order_count")},
    {_weighted("avg_eta_sec")}, {_weighted("p90_eta_sec")}
FROM uc12_eta_accuracy GROUP BY zone_id, weather_condition"""
_LONGEST = "ORDER BY avg_eta_sec DESC, zone_id, weather_condition"

_oracle("dash_eta_summary", f"{_ETA} {_LONGEST}", "uc12_eta_accuracy")
_oracle(
    "dash_eta_kpis",
    f"""SELECT {_sum("order_count")}, {_weighted("avg_eta_sec")}, {_weighted("p90_eta_sec")}
FROM uc12_eta_accuracy""",
    "uc12_eta_accuracy",
)
_oracle(
    "dash_eta_pivot",
    "SELECT weather_condition, "
    + ", ".join(f"avg(avg_eta_sec) FILTER (WHERE zone_id = '{z}') AS {z}" for z in (*_ZONES, "zone_airport"))
    + f", avg(avg_eta_sec) FILTER (WHERE zone_id NOT IN {_ZONES}) AS other_zones"
    f" FROM ({_ETA}) WHERE weather_condition IN {_WEATHER} GROUP BY weather_condition",
    "uc12_eta_accuracy",
)
_oracle("dash_eta_top10", f"{_ETA} {_LONGEST} LIMIT 10", "uc12_eta_accuracy")
_oracle(
    "dash_anomaly_kpis",
    f"""SELECT *, {_percent("total_anomalies", "total_events")} AS anomaly_rate_pct
FROM (SELECT {_sum("total_events", "total_anomalies")} FROM uc7_anomalies)""",
    "uc7_anomalies",
)
_oracle(
    "dash_anomaly_by_zone",
    f"""SELECT zone_id, {_sum("impossible_speed", "location_jump", "offline_mid_delivery")}
FROM uc7_anomalies GROUP BY zone_id""",
    "uc7_anomalies",
)
_oracle(
    "dash_anomaly_rate_over_time",
    f"""SELECT window_start, {_percent("total_anomalies", "total_events")} AS anomaly_rate_pct
FROM (SELECT window_start, {_sum("total_events", "total_anomalies")}
    FROM uc7_anomalies GROUP BY window_start)
ORDER BY window_start""",
    "uc7_anomalies",
)


def _per_session(name: str) -> str:
    return f"sum({_cents(name)} * session_count) / sum(session_count)"


_PRODUCTIVITY = f"""SELECT vehicle_type, zone_id, {bigint("sum(session_count)")} AS sessions,
    round_even({_per_session("avg_deliveries")}, 0) / 100 AS avg_deliveries,
    round_even(median(p50_deliveries), 1) AS p50_deliveries,
    round_even(median(p90_deliveries), 1) AS p90_deliveries,
    round_even({_per_session("deliveries_per_hour")}, 0) / 100 AS deliveries_per_hour
FROM uc13_courier_productivity GROUP BY vehicle_type, zone_id"""

_oracle("dash_productivity_rollup", _PRODUCTIVITY, "uc13_courier_productivity")
_oracle(
    "dash_productivity_kpis",
    f"""SELECT {bigint("sum(session_count)")} AS sessions,
    {_per_session("avg_deliveries")} / 100 AS avg_deliveries,
    {_per_session("deliveries_per_hour")} / 100 AS deliveries_per_hour
FROM uc13_courier_productivity""",
    "uc13_courier_productivity",
)
_oracle(
    "dash_productivity_pivot",
    "SELECT zone_id, "
    + ", ".join(
        f"max(deliveries_per_hour) FILTER (WHERE vehicle_type = '{v}') AS {v}" for v in _VEHICLES
    )
    + f" FROM ({_PRODUCTIVITY}) GROUP BY zone_id",
    "uc13_courier_productivity",
)
_oracle(
    "dash_productivity_ranked",
    f"{_PRODUCTIVITY} ORDER BY deliveries_per_hour DESC, vehicle_type, zone_id",
    "uc13_courier_productivity",
)

# --- feeds -------------------------------------------------------------------

_ORDER_COLUMNS = """event_id, order_id, customer_id, restaurant_id, courier_id, zone_id,
    order_status, previous_status, event_timestamp, ingestion_timestamp, order_total_cents,
    estimated_prep_time_seconds, estimated_delivery_time_seconds, actual_prep_time_seconds,
    actual_delivery_time_seconds, is_peak_hour, weather_condition, cancellation_reason,
    cast(tenths / 10 AS float) AS customer_rating, is_duplicate, is_late_arrival"""
_COURIER_COLUMNS = """event_id, courier_id, order_id, zone_id, courier_status, previous_status,
    event_timestamp, ingestion_timestamp, latitude, longitude, location_accuracy_meters,
    heading_degrees, distance_to_restaurant_meters, distance_to_customer_meters,
    vehicle_type, session_id, shift_duration_seconds,
    deliveries_completed_in_session, is_duplicate, is_late_arrival, anomaly_flag"""

_oracle("feed_orders", f"SELECT {_ORDER_COLUMNS} FROM order_feed", "order_feed")
_oracle("feed_couriers", f"SELECT {_COURIER_COLUMNS} FROM courier_feed", "courier_feed")
_oracle("io_jsonl_roundtrip", f"SELECT {_ORDER_COLUMNS} FROM order_feed", "order_feed")
_oracle(
    "io_avro_roundtrip",
    f"""SELECT * REPLACE (nullif(previous_status, 'LOST') AS previous_status,
    nullif(anomaly_flag, 'GHOST') AS anomaly_flag)
FROM (SELECT {_COURIER_COLUMNS} FROM courier_feed)""",
    "courier_feed",
)
_oracle("io_results_roundtrip", "SELECT * FROM uc1_order_volume", "uc1_order_volume")
_oracle(
    "feed_timeline",
    """SELECT 'orders' AS feed, event_id, order_id AS entity_id, order_status AS status, zone_id,
    event_timestamp, ingestion_timestamp FROM order_feed
UNION ALL
SELECT 'couriers', event_id, courier_id, courier_status, zone_id,
    event_timestamp, ingestion_timestamp FROM courier_feed
ORDER BY ingestion_timestamp, event_id""",
    "order_feed",
    "courier_feed",
)
_oracle(
    "feed_status_counts",
    "SELECT order_status, count(*) AS events FROM order_feed GROUP BY order_status",
    "order_feed",
)
_oracle(
    "feed_anomaly_counts",
    "SELECT anomaly_flag, count(*) AS events FROM courier_feed GROUP BY anomaly_flag",
    "courier_feed",
)
_oracle(
    "feed_edge_case_counts",
    """SELECT order_duplicates, order_late_arrivals, courier_duplicates, courier_late_pings,
    courier_anomalies, o + c AS total_events
FROM (SELECT count(*) AS o, count(*) FILTER (WHERE is_duplicate) AS order_duplicates,
        count(*) FILTER (WHERE is_late_arrival) AS order_late_arrivals FROM order_feed),
    (SELECT count(*) AS c, count(*) FILTER (WHERE is_duplicate) AS courier_duplicates,
        count(*) FILTER (WHERE is_late_arrival) AS courier_late_pings,
        count(anomaly_flag) AS courier_anomalies FROM courier_feed)""",
    "order_feed",
    "courier_feed",
)

# --- data quality ------------------------------------------------------------

_oracle(
    "q_late_arrivals",
    f"""SELECT feed, zone_id, count(*) AS events, count(*) FILTER (WHERE lag > 30000) AS late_by_lag,
    count(*) FILTER (WHERE flagged) AS late_by_flag,
    count(*) FILTER (WHERE (lag > 30000) = flagged) AS agreeing,
    count(*) FILTER (WHERE lag < 0) AS negative_lag,
    {rounded("avg(lag) FILTER (WHERE lag >= 0)", 2)} AS avg_lag_ms,
    max(lag) FILTER (WHERE lag >= 0) AS max_lag_ms,
    quantile_disc(lag // 1000, 0.95) FILTER (WHERE lag >= 0) AS p95_lag_s
FROM (SELECT 'orders' AS feed, zone_id, is_late_arrival AS flagged, ims - ms AS lag FROM order_feed
    UNION ALL
    SELECT 'couriers', zone_id, is_late_arrival, ims - ms FROM courier_feed)
GROUP BY feed, zone_id""",
    "order_feed",
    "courier_feed",
)
_oracle(
    "q_location_jumps",
    f"""SELECT event_id, courier_id, session_id, vehicle_type,
    make_timestamp(ms * 1000) AS event_timestamp, {rounded("kmh", 3)} AS implied_kmh
FROM judged WHERE detected""",
    "judged",
)
_oracle(
    "q_anomaly_label_score",
    f"""SELECT 'LOCATION_JUMP' AS anomaly_flag, labelled, detected, true_positives,
    {rounded("true_positives / detected", 4)} AS precision,
    {rounded("true_positives / labelled", 4)} AS recall
FROM (SELECT count(*) FILTER (WHERE labelled_jump) AS labelled,
        count(*) FILTER (WHERE detected) AS detected,
        count(*) FILTER (WHERE detected AND labelled_jump) AS true_positives FROM judged)
UNION ALL
SELECT 'IMPOSSIBLE_SPEED', count(*) FILTER (WHERE labelled_speed), NULL, NULL, NULL, NULL
FROM judged""",
    "judged",
)
_DEDUP_ORDERS = """SELECT event_id, order_id, order_status, event_timestamp, ingestion_timestamp,
    is_duplicate FROM order_feed
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp, is_duplicate) = 1"""
_oracle("q_dedup_orders", _DEDUP_ORDERS, "order_feed")
_oracle(
    "q_dedup_couriers",
    """SELECT event_id, courier_id, session_id, event_timestamp, courier_status,
    ingestion_timestamp, is_duplicate FROM courier_feed
QUALIFY row_number() OVER (PARTITION BY courier_id, session_id, event_timestamp, courier_status
    ORDER BY ingestion_timestamp, is_duplicate, event_id) = 1""",
    "courier_feed",
)
_oracle(
    "q_lifecycle_gaps",
    """SELECT order_id, zone_id, from_status, to_status, make_timestamp(ms * 1000) AS event_timestamp,
    cast(CASE WHEN gap = 'SKIPPED_STEP' THEN stride - 1 ELSE 0 END AS int) AS skipped_steps, gap,
    from_status IN ('DELIVERED', 'CANCELLED', 'FAILED') AS after_end
FROM (SELECT *, CASE WHEN to_status IN ('CANCELLED', 'FAILED')
            OR from_status IN ('DELIVERED', 'CANCELLED', 'FAILED') THEN 'ILLEGAL'
        WHEN stride > 1 THEN 'SKIPPED_STEP' ELSE 'STEP_BACK' END AS gap
    FROM transitions
    WHERE NOT (to_status = 'CANCELLED' AND from_status IN ('PLACED', 'ACCEPTED', 'PREPARING',
            'READY_FOR_PICKUP', 'PICKED_UP'))
        AND NOT (to_status NOT IN ('CANCELLED', 'FAILED') AND stride = 1)
    UNION ALL BY NAME
    SELECT *, order_status AS to_status, 0 AS stride, 'REPEATED' AS gap
    FROM history WHERE from_status = order_status)""",
    "history",
    "transitions",
)
_oracle(
    "q_impossible_durations",
    """SELECT order_id, from_status, to_status, seconds, low_seconds, high_seconds
FROM (SELECT t.*, coalesce(lo, 30) AS low_seconds,
        cast(coalesce(hi, 120) * CASE WHEN to_status = 'READY_FOR_PICKUP' AND is_peak_hour THEN 140
            WHEN to_status = 'DELIVERED' THEN CASE weather_condition WHEN 'RAIN' THEN 120
                WHEN 'HEAVY_RAIN' THEN 145 WHEN 'SNOW' THEN 160 ELSE 100 END
            ELSE 100 END // 100 AS int) AS high_seconds
    FROM transitions t LEFT JOIN (VALUES ('PLACED', 'ACCEPTED', 30, 120),
        ('ACCEPTED', 'PREPARING', 10, 60), ('PREPARING', 'READY_FOR_PICKUP', 480, 1500),
        ('READY_FOR_PICKUP', 'PICKED_UP', 60, 600), ('PICKED_UP', 'EN_ROUTE', 5, 30),
        ('EN_ROUTE', 'DELIVERED', 300, 1800),
        ('PICKED_UP', 'CANCELLED', 300, 900)) b(a, z, lo, hi)
        ON from_status = a AND to_status = z)
WHERE seconds < low_seconds OR seconds > high_seconds""",
    "transitions",
)


def _violations(feed: str, view: str, column: str, symbols: str) -> str:
    allowed = ", ".join(f"'{s}'" for s in symbols.split())
    return (
        f"SELECT '{feed}' AS feed, '{column}' AS column_name, "
        f"count(*) FILTER (WHERE {column} NOT IN ({allowed})) AS violations FROM {view}"
    )


_ORDER_STATUS = (
    "PLACED ACCEPTED PREPARING READY_FOR_PICKUP PICKED_UP EN_ROUTE DELIVERED CANCELLED FAILED"
)
_oracle(
    "q_enum_violations",
    " UNION ALL ".join(
        [
            _violations("orders", "order_feed", "order_status", _ORDER_STATUS),
            _violations("orders", "order_feed", "previous_status", _ORDER_STATUS),
            _violations(
                "orders", "order_feed", "weather_condition", "CLEAR RAIN HEAVY_RAIN SNOW"
            ),
            _violations(
                "orders",
                "order_feed",
                "cancellation_reason",
                "CUSTOMER_REQUEST RESTAURANT_CLOSED RESTAURANT_REJECTED NO_COURIER_AVAILABLE "
                "PAYMENT_FAILED ITEM_UNAVAILABLE FRAUD_DETECTED SYSTEM_ERROR",
            ),
            _violations(
                "couriers",
                "courier_feed",
                "courier_status",
                "ONLINE_IDLE HEADING_TO_RESTAURANT WAITING_AT_RESTAURANT PICKED_UP "
                "EN_ROUTE_TO_CUSTOMER DELIVERED OFFLINE BREAK",
            ),
            _violations(
                "couriers",
                "courier_feed",
                "previous_status",
                "ONLINE_IDLE HEADING_TO_RESTAURANT WAITING_AT_RESTAURANT PICKED_UP "
                "EN_ROUTE_TO_CUSTOMER DELIVERED OFFLINE BREAK",
            ),
            _violations("couriers", "courier_feed", "vehicle_type", " ".join(_VEHICLES)),
            _violations(
                "couriers",
                "courier_feed",
                "anomaly_flag",
                "IMPOSSIBLE_SPEED LOCATION_JUMP OFFLINE_MID_DELIVERY CLOCK_SKEW DUPLICATE_PING",
            ),
        ]
    ),
    "order_feed",
    "courier_feed",
)
_oracle(
    "q_offline_mid_delivery",
    """SELECT zone_id, count(*) FILTER (WHERE found) AS detected,
    count(*) FILTER (WHERE flagged) AS flagged, count(*) FILTER (WHERE found AND flagged) AS agreeing
FROM (SELECT zone_id, courier_status = 'OFFLINE' AND order_id IS NOT NULL AS found,
        coalesce(anomaly_flag = 'OFFLINE_MID_DELIVERY', false) AS flagged FROM courier_feed)
GROUP BY zone_id""",
    "courier_feed",
)

# --- further analytics -------------------------------------------------------

_PROMISES = f"""SELECT zone_id, weather_condition, count(error_seconds) AS deliveries,
    count(*) FILTER (WHERE error_seconds IS NULL) AS unresolved,
    {rounded("avg(error_seconds)", 2)} AS mean_error_sec,
    {rounded("avg(abs(error_seconds))", 2)} AS mean_abs_error_sec,
    quantile_disc(error_seconds, 0.9) AS p90_error_sec,
    {rounded("count(*) FILTER (WHERE error_seconds > 0) / nullif(count(error_seconds), 0)", 4)} AS late_share
FROM promise_errors GROUP BY zone_id, weather_condition"""
_oracle("x_eta_accuracy", _PROMISES, "promise_errors")
_oracle("stream_x_eta_accuracy", _PROMISES, "promise_errors")
_oracle(
    "uc9_supply_demand_approx",
    """SELECT window_start, window_end, window_date, zone_id, demand_orders, supply_couriers,
    true AS within_error FROM uc9_supply_demand""",
    "uc9_supply_demand",
)
_oracle(
    "x_surge_zones",
    "SELECT * FROM uc9_supply_demand WHERE demand_supply_ratio >= 3.0",
    "uc9_supply_demand",
)
_OUTER = f"""SELECT d.window_start, d.window_end, d.window_date, d.zone_id, demand_orders,
    coalesce(supply_couriers, 0) AS supply_couriers,
    {rounded("demand_orders / greatest(coalesce(supply_couriers, 0), 1)", 2)} AS demand_supply_ratio
FROM demand d LEFT JOIN supply s ON d.window_start = s.window_start AND d.zone_id = s.zone_id"""
_oracle("x_supply_demand_outer", _OUTER, "demand", "supply")
_oracle("stream_x_supply_demand_outer", _OUTER, "demand", "supply")
_oracle(
    "x_item_sales",
    f"""SELECT item_id, order_lines, quantity, revenue_eur, p_name AS item_name
FROM (SELECT item_id, count(*) AS order_lines, {_sum("quantity")},
        sum(quantity * unit_price_cents) / 100 AS revenue_eur FROM items GROUP BY item_id) s
LEFT JOIN part ON 'item_' || p_partkey = item_id""",
    "items",
)
_oracle(
    "x_order_total_check",
    """SELECT zone_id, count(*) AS orders,
    count(*) FILTER (WHERE order_total_cents IS NULL) AS without_total,
    count(*) FILTER (WHERE item_cents IS NULL) AS without_items,
    count(*) FILTER (WHERE order_total_cents = item_cents) AS matching,
    count(*) FILTER (WHERE order_total_cents <> item_cents) AS differing
FROM order_feed o LEFT JOIN (SELECT order_id, sum(quantity * unit_price_cents) AS item_cents
    FROM items GROUP BY order_id) i ON o.order_id = i.order_id
WHERE NOT is_duplicate AND order_status = 'PLACED' GROUP BY zone_id""",
    "order_feed",
    "items",
)
_oracle(
    "x_eta_formula_check",
    f"""SELECT zone_id, count(*) AS placed,
    count(*) FILTER (WHERE (hour(event_timestamp) IN (12, 13, 14, 19, 20, 21)) <> is_peak_hour)
        AS peak_differs,
    count(*) FILTER (WHERE formula <> stated) AS promise_differs,
    {bigint("sum(stated - formula)")} AS promise_drift_sec
FROM (SELECT *, estimated_delivery_time_seconds AS stated,
        (estimated_prep_time_seconds + 900) * CASE weather_condition WHEN 'RAIN' THEN 120
            WHEN 'HEAVY_RAIN' THEN 145 WHEN 'SNOW' THEN 160 ELSE 100 END // 100 AS formula
    FROM order_feed WHERE NOT is_duplicate AND order_status = 'PLACED')
GROUP BY zone_id""",
    "order_feed",
)
_oracle(
    "x_zone_of_ping",
    """SELECT zone_id, CASE
    WHEN latitude >= 40.705::double AND latitude < 40.725::double
        AND longitude >= -74.01::double AND longitude < -73.99::double THEN 'zone_downtown'
    WHEN latitude >= 40.725::double AND latitude < 40.755::double
        AND longitude >= -74.005::double AND longitude < -73.975::double THEN 'zone_midtown'
    WHEN latitude >= 40.65::double AND latitude < 40.7::double
        AND longitude >= -74.01::double AND longitude < -73.96::double THEN 'zone_west'
    WHEN latitude >= 40.71::double AND latitude < 40.745::double
        AND longitude >= -73.97::double AND longitude < -73.94::double THEN 'zone_east'
    WHEN latitude >= 40.755::double AND latitude < 40.79::double
        AND longitude >= -73.99::double AND longitude < -73.95::double THEN 'zone_uptown'
    WHEN latitude >= 40.6::double AND latitude < 40.65::double
        AND longitude >= -74.05::double AND longitude < -73.9::double THEN 'zone_suburbs'
    END AS located_zone, count(*) AS pings
FROM courier_feed GROUP BY ALL""",
    "courier_feed",
)
_WEIGHTS = (
    "[10, 5, 3, 2, 2, 5, 15, 35, 50, 40, 35, 70, "
    "180, 200, 120, 80, 70, 100, 180, 220, 200, 150, 90, 40]"
)
_oracle(
    "x_demand_curve",
    f"""SELECT order_date, order_hour, orders,
    {rounded("orders / sum(orders) OVER (PARTITION BY order_date)", 4)} AS share,
    {rounded("weight * CASE WHEN dayofweek(order_date) IN (0, 6) THEN 125 ELSE 100 END / 10000", 4)}
        AS demand_weight,
    {rounded(f"weight / list_sum({_WEIGHTS})", 4)} AS expected_share
FROM (SELECT order_date, order_hour, orders, {_WEIGHTS}[order_hour + 1] AS weight
    FROM (SELECT cast(event_timestamp AS date) AS order_date,
            cast(hour(event_timestamp) AS int) AS order_hour, count(*) AS orders
        FROM order_feed WHERE NOT is_duplicate AND order_status = 'PLACED' GROUP BY ALL))""",
    "order_feed",
)
_oracle(
    "x_cancel_reasons",
    f"""SELECT zone_id, cancellation_reason, cancellations,
    {rounded("cancellations / sum(cancellations) OVER (PARTITION BY zone_id)", 4)} AS share
FROM (SELECT zone_id, cancellation_reason, count(*) AS cancellations
    FROM order_feed WHERE NOT is_duplicate AND order_status = 'CANCELLED' GROUP BY ALL)""",
    "order_feed",
)
_oracle(
    "x_ratings",
    f"""SELECT restaurant_id, count(*) AS ratings,
    {rounded("sum(tenths) / count(*) / 10", 3)} AS avg_rating
FROM order_feed WHERE NOT is_duplicate AND tenths IS NOT NULL GROUP BY restaurant_id""",
    "order_feed",
)
_oracle(
    "x_step_durations",
    f"""SELECT zone_id, from_status, to_status, count(*) AS steps,
    {rounded("avg(seconds)", 2)} AS avg_seconds, quantile_disc(seconds, 0.95) AS p95_seconds
FROM transitions GROUP BY zone_id, from_status, to_status""",
    "transitions",
)

# --- sketches ------------------------------------------------------------------


def _exact(of: str, zone: str, kind: str, value: str, source: str, *percents: int) -> str:
    """Exact percentiles of a value: the least one that so many percent do not pass."""
    return " UNION ALL ".join(
        f"SELECT '{of}' AS of, {zone} AS zone_id, {kind} AS kind, 'p{p}' AS percentile, "
        f"count(*) AS value_count, cast(min(v) FILTER (WHERE i * 100 >= {p} * n) AS bigint) AS exact_value, "
        f"true AS within_error FROM (SELECT *, {value} AS v, "
        f"count(*) OVER (PARTITION BY {zone}, {kind}) AS n, "
        f"row_number() OVER (PARTITION BY {zone}, {kind} ORDER BY {value}) AS i FROM {source}) GROUP BY ALL"
        for p in percents
    )


_ORIGINAL = "(SELECT * FROM order_feed WHERE NOT is_duplicate AND order_status"
_oracle(
    "x_merged_percentiles",
    _exact("delivery", "cast(NULL AS varchar)", "weather_condition", "actual_delivery_time_seconds",
           f"{_ORIGINAL} = 'DELIVERED' AND actual_delivery_time_seconds IS NOT NULL)", 50, 95)
    + " UNION ALL "
    + _exact("promise", "zone_id", "weather_condition", "estimated_delivery_time_seconds",
             f"{_ORIGINAL} = 'PLACED' AND estimated_delivery_time_seconds IS NOT NULL)", 90)
    + " UNION ALL "
    + _exact("sessions", "zone_id", "vehicle_type", "deliveries",
             "(SELECT ms // 60000 AS minute, zone_id, vehicle_type, session_id, "
             "max(deliveries_completed_in_session) AS deliveries FROM courier_feed WHERE NOT is_duplicate "
             "AND shift_duration_seconds IS NOT NULL AND deliveries_completed_in_session IS NOT NULL GROUP BY ALL)",
             50, 90),
    "order_feed",
    "courier_feed",
)
_oracle(
    "x_idle_couriers_by_hour",
    """SELECT make_timestamp((ms // 3600000) * 3600000000) AS hour_start, zone_id,
    count(DISTINCT courier_id) AS idle_couriers, true AS within_error
FROM courier_feed WHERE NOT is_duplicate AND courier_status = 'ONLINE_IDLE' GROUP BY ALL""",
    "courier_feed",
)

# --- stateful streams --------------------------------------------------------

_oracle(
    "stream_dedup",
    """SELECT DISTINCT event_id, order_id, order_status, event_timestamp FROM order_feed""",
    "order_feed",
)
_oracle(
    "stream_session_windows",
    """SELECT courier_id, make_timestamp(min(ms) * 1000) AS session_start,
    make_timestamp((max(ms) + 300000) * 1000) AS session_end, count(*) AS pings
FROM (SELECT *, sum(fresh) OVER (PARTITION BY courier_id ORDER BY ms ROWS UNBOUNDED PRECEDING) AS n
    FROM (SELECT courier_id, ms, CASE WHEN ms - lag(ms) OVER (PARTITION BY courier_id ORDER BY ms)
            <= 300000 THEN 0 ELSE 1 END AS fresh
        FROM courier_feed WHERE NOT is_duplicate))
GROUP BY courier_id, n""",
    "courier_feed",
)

_ORIGINALS = "order_feed WHERE NOT is_duplicate"
_PINGS = "courier_feed WHERE NOT is_duplicate"
_INPUTS = {
    ("uc1_order_volume", "orders"): _ORIGINALS,
    ("uc3_prep_sla", "orders"): f"{_ORIGINALS} AND order_status = 'READY_FOR_PICKUP' AND actual_prep_time_seconds > 1200",
    ("uc4_weather", "orders"): f"{_ORIGINALS} AND order_status = 'DELIVERED' AND actual_delivery_time_seconds IS NOT NULL",
    ("uc7_anomalies", "couriers"): "courier_feed",
    ("uc9_supply_demand", "orders"): f"{_ORIGINALS} AND order_status = 'PLACED'",
    ("uc9_supply_demand", "couriers"): f"{_PINGS} AND courier_status = 'ONLINE_IDLE'",
    ("uc10_processing_time", "orders"): f"{_ORIGINALS} AND order_status = 'READY_FOR_PICKUP' "
    "AND actual_prep_time_seconds IS NOT NULL",
    ("uc11_order_value", "orders"): f"{_ORIGINALS} AND order_status = 'PLACED' AND order_total_cents IS NOT NULL",
    ("uc12_eta_accuracy", "orders"): f"{_ORIGINALS} AND order_status = 'PLACED' "
    "AND estimated_delivery_time_seconds IS NOT NULL",
    ("uc13_courier_productivity", "couriers"): f"{_PINGS} AND shift_duration_seconds IS NOT NULL "
    "AND deliveries_completed_in_session IS NOT NULL",
}
_SEEN = " UNION ALL ".join(
    f"SELECT '{analytic}' AS analytic, '{feed}' AS feed, ms, ims FROM {rows}"
    for (analytic, feed), rows in _INPUTS.items()
)
# An event is lost if its window ends no later than the watermark that the batch before its own used:
# the latest event of all earlier batches less 30 seconds, of both feeds the lower one.
_oracle(
    "stream_late_rows",
    f"""SELECT analytic, feed, count(*) AS events_seen, count(*) FILTER (lost) AS events_lost,
    max((ims - ms) / 1000) FILTER (lost) AS longest_lag_seconds, true AS as_dropped
FROM (SELECT s.*, (s.ms // 60000 + 1) * 60000 <= w.watermark AS lost
    FROM (SELECT e.*, (SELECT count(*) FROM cuts WHERE e.ims > cut) AS batch FROM ({_SEEN}) e) s
    JOIN (SELECT analytic, batch, min(top) - 30000 AS watermark
        FROM (SELECT i.analytic, i.feed, b.batch, coalesce(max(top), 30000) AS top
            FROM (SELECT DISTINCT analytic, feed FROM ({_SEEN})) i CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS batch) b
            LEFT JOIN (SELECT analytic, feed, max(ms) AS top, (SELECT count(*) FROM cuts WHERE e.ims > cut) AS batch
                FROM ({_SEEN}) e GROUP BY ALL) t
                ON t.analytic = i.analytic AND t.feed = i.feed AND t.batch <= b.batch - 2
            GROUP BY ALL)
        GROUP BY ALL) w ON w.analytic = s.analytic AND w.batch = s.batch)
GROUP BY ALL""",
    "order_feed",
    "courier_feed",
    "cuts",
)
ORACLES["stream_location_jumps"] = ORACLES["q_location_jumps"]
for _name in ("dash_order_kpis", "dash_revenue_by_zone"):
    ORACLES[f"stream_{_name}"] = ORACLES[_name]

# What streams hold while their feeds go on: open windows, and orders whose delivery may still come. The
# watermark is the latest event of each input less its lateness; of two inputs the lower one.
_PLACED = f"(SELECT order_id, ms FROM {_INPUTS['uc12_eta_accuracy', 'orders']})"
_DONE = f"(SELECT order_id, ms FROM {_INPUTS['uc4_weather', 'orders']} AND tenths IS NULL)"
_DEMAND = f"(SELECT * FROM {_INPUTS['uc9_supply_demand', 'orders']})"
_IDLE = f"(SELECT * FROM {_INPUTS['uc9_supply_demand', 'couriers']})"
_ACTIVE = f"(SELECT * FROM {_INPUTS['uc13_courier_productivity', 'couriers']})"


def _held(query: str, operator: int, name: str, side: str, rows: str, expired: str = "0") -> str:
    return (
        f"SELECT '{query}' AS query, cast({operator} AS bigint) AS operator_id, '{name}' AS operator, "
        f"cast({side} AS varchar) AS side, {rows} AS state_rows, cast({expired} AS bigint) AS expired_rows, "
        f"make_timestamp((SELECT {query} FROM marks) * 1000) AS watermark"
    )


def _open_windows(query: str, source: str, *keys: str) -> str:
    minute = "ms // 60000 AS minute"
    return (
        f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join((minute, *keys))} FROM {source}) "
        f"WHERE (minute + 1) * 60000 > (SELECT {query} FROM marks))"
    )


def _count(source: str, condition: str) -> str:
    mark = "(SELECT x_eta_accuracy FROM marks)"
    return f"(SELECT count(DISTINCT order_id) FROM {source} WHERE {condition.format(mark=mark)})"


_SAVE, _ONCE, _JOIN = "stateStoreSave", "dedupeWithinWatermark", "symmetricHashJoin"
_oracle(
    "stream_state_audit",
    f"""SELECT * FROM (WITH marks AS (SELECT
    (SELECT max(ms) FROM {_ACTIVE}) - 30000 AS uc13_courier_productivity,
    least((SELECT max(ms) FROM {_DEMAND}), (SELECT max(ms) FROM {_IDLE})) - 30000 AS uc9_supply_demand,
    least((SELECT max(ms) FROM {_PLACED}), (SELECT max(ms) FROM {_DONE})) - 305000 AS x_eta_accuracy) """
    + " UNION ALL ".join(
        [
            _held("uc13_courier_productivity", 0, _SAVE, "NULL", "0"),
            _held("uc13_courier_productivity", 1, _SAVE, "NULL", _open_windows(
                "uc13_courier_productivity", _ACTIVE, "zone_id", "vehicle_type", "session_id")),
            _held("uc9_supply_demand", 0, _JOIN, "'left'", "0"),
            _held("uc9_supply_demand", 0, _JOIN, "'right'", "0"),
            _held("uc9_supply_demand", 1, _SAVE, "NULL", _open_windows("uc9_supply_demand", _DEMAND, "zone_id")),
            _held("uc9_supply_demand", 2, _SAVE, "NULL", "0"),
            _held("uc9_supply_demand", 3, _SAVE, "NULL", _open_windows(
                "uc9_supply_demand", _IDLE, "zone_id", "courier_id")),
            _held("x_eta_accuracy", 0, _JOIN, "'left'",
                  _count(_PLACED, "ms <= {mark} AND ms + 6 * 3600000 >= {mark}"), "NULL"),
            _held("x_eta_accuracy", 0, _JOIN, "'right'", "0", "NULL"),
            _held("x_eta_accuracy", 1, _ONCE, "NULL",
                  _count(_PLACED, "ms <= {mark} AND ms + 305000 > {mark}"), "NULL"),
            _held("x_eta_accuracy", 2, _SAVE, "NULL", _count(_PLACED, "ms > {mark}"), "NULL"),
            _held("x_eta_accuracy", 3, _ONCE, "NULL",
                  _count(_DONE, "ms <= {mark} AND ms + 305000 > {mark}"), "NULL"),
            _held("x_eta_accuracy", 4, _SAVE, "NULL", _count(_DONE, "ms > {mark}"), "NULL"),
        ]
    )
    + ")",
    "order_feed",
    "courier_feed",
)
