"""Named queries the oracle statements build on: feeds and windowed results.

``NEEDS`` lists what a view reads; ``statement`` puts the views a query needs
in front of it as a WITH clause.
"""

from __future__ import annotations


def rounded(value: str, digits: int) -> str:
    """Half-up rounding of the decimal text of a double, as Spark rounds."""
    exact = f"cast(cast({value} AS varchar) AS decimal(38, 18))"
    return f"cast(round({exact}, {digits}) AS double)"


def bigint(value: str) -> str:
    return f"cast({value} AS bigint)"


def _window(ms: str = "ms") -> str:
    start = f"make_timestamp(({ms} // 60000) * 60000000)"
    return (
        f"{start} AS window_start, {start} + INTERVAL 1 MINUTE AS window_end, "
        f"cast({start} AS date) AS window_date"
    )


VIEWS: dict[str, str] = {}
NEEDS: dict[str, tuple[str, ...]] = {}


def _view(name: str, sql: str, *needs: str) -> None:
    VIEWS[name] = sql
    NEEDS[name] = needs


_ZONE = (
    "CASE {0} WHEN 0 THEN 'zone_downtown' WHEN 1 THEN 'zone_midtown' WHEN 2 THEN 'zone_west' "
    "WHEN 3 THEN 'zone_east' WHEN 4 THEN 'zone_uptown' ELSE 'zone_suburbs' END"
)
_STATE = (
    "CASE {0} WHEN 0 THEN 'PLACED' WHEN 1 THEN 'ACCEPTED' WHEN 2 THEN 'PREPARING' "
    "WHEN 3 THEN 'READY_FOR_PICKUP' WHEN 4 THEN 'PICKED_UP' WHEN 5 THEN 'EN_ROUTE' "
    "ELSE 'DELIVERED' END"
)

_view(
    "basket",
    """SELECT o_orderkey AS k, 'item_' || (o_orderkey // 8 + j * 5) AS item_id,
    (o_orderkey + j) % 3 + 1 AS quantity, 300 + (o_orderkey * 7 + j * 11) % 1500 AS unit_price_cents
FROM orders CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS j) WHERE j <= o_orderkey % 4""",
)
_view(
    "totals",
    """SELECT k, cast(sum(quantity * unit_price_cents) + CASE WHEN k % 211 = 5 THEN 1 ELSE 0 END
    AS bigint) AS cents
FROM basket GROUP BY k""",
    "basket",
)
_view(
    "drawn",
    """SELECT *,
    CASE WHEN k % 401 = 7 THEN 3 ELSE 30 + a1 END AS d1, 10 + a2 AS d2, (480 + a3) * pm // 10 AS d3,
    CASE WHEN k % 401 = 8 THEN 9000 ELSE 60 + a4 END AS d4, 5 + a2 % 26 AS d5,
    CASE WHEN k % 401 = 9 THEN 25200 ELSE (300 + a5) * wm // 100 END AS d6,
    (600 + ep) * pm // 10 AS eprep
FROM (SELECT *, off_s // 3600 + 11 IN (12, 13, 14, 19, 20, 21) AS peak,
        CASE WHEN off_s // 3600 + 11 IN (12, 13, 14, 19, 20, 21) THEN 14 ELSE 10 END AS pm,
        pc < 14 AS gone, pc >= 14 AND skip < 3 AS skipping,
        CASE WHEN pc < 12 THEN (k * 13) % 4 + 1 ELSE 5 END AS cancel_at
    FROM (SELECT o_orderkey AS k, o_custkey AS c, cents, o_orderkey // 5000 AS day,
            (o_orderkey * 7919) % 14400 AS off_s,
            (o_orderkey * 31) % 91 AS a1, (o_orderkey * 37) % 51 AS a2,
            (o_orderkey * 6131) % 1021 AS a3, (o_orderkey * 541) % 541 AS a4,
            (o_orderkey * 3571) % 1501 AS a5, 300 + (o_orderkey * 17) % 601 AS vz,
            (o_orderkey * 53) % 97 AS pc, (o_orderkey * 67) % 103 AS rt,
            (o_orderkey * 1009) % 1201 AS ep, (o_orderkey * 71) % 107 AS skip,
            CASE WHEN o_orderkey % 499 = 3 THEN 'FOG' ELSE CASE substr(o_orderpriority, 1, 1)
                WHEN '3' THEN 'RAIN' WHEN '4' THEN 'HEAVY_RAIN' WHEN '5' THEN 'SNOW'
                ELSE 'CLEAR' END END AS weather,
            CASE WHEN o_orderkey % 499 = 3 THEN 100 ELSE CASE substr(o_orderpriority, 1, 1)
                WHEN '3' THEN 120 WHEN '4' THEN 145 WHEN '5' THEN 160 ELSE 100 END END AS wm
        FROM orders LEFT JOIN totals ON totals.k = o_orderkey))""",
    "totals",
)


def _elapsed() -> str:
    usual = {3: "CASE WHEN skipping THEN 0 ELSE d3 END", 4: "CASE WHEN skipping THEN 30 + a1 ELSE d4 END"}
    return " + ".join(
        f"CASE WHEN i < {j} THEN 0 WHEN gone AND cancel_at = {j} THEN "
        f"CASE WHEN pc < 12 THEN 30 + a1 ELSE vz END ELSE {usual.get(j, f'd{j}')} END"
        for j in range(1, 7)
    )


_view(
    "steps",
    f"""SELECT *,
    CASE WHEN gone AND i = cancel_at THEN 'CANCELLED' ELSE {_STATE.format("i")} END AS status,
    CASE WHEN i = 0 THEN NULL WHEN i = 4 AND skipping THEN 'PREPARING'
        ELSE {_STATE.format("i - 1")} END AS previous,
    {_elapsed()} AS el
FROM drawn CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS i)
WHERE (gone AND i <= cancel_at) OR (NOT gone AND NOT (skipping AND i = 3))""",
    "drawn",
)
_view(
    "once",
    """SELECT *, ms + CASE WHEN late THEN 30000 + (k * 17 % 270) * 1000 ELSE 50 + k % 1951 END AS ims
FROM (SELECT *, 'oe_' || k || '_' || i AS event_id, (k * 7 + i) % 19 = 0 AS late,
        1704106800000 + day * 86400000 + (off_s + el) * 1000 AS ms, cast(NULL AS bigint) AS tenths
    FROM steps)""",
    "steps",
)
_view(
    "rated",
    """SELECT * FROM once UNION ALL
SELECT * REPLACE (event_id || '_r' AS event_id, ms + (60 + k % 3541) * 1000 AS ms,
    true AS late, 10 + k % 41 AS tenths)
FROM once WHERE status = 'DELIVERED' AND rt < 65""",
    "once",
)
_view(
    "strays",
    """SELECT * REPLACE (event_id || '_x' AS event_id, status AS previous,
    CASE i WHEN 6 THEN 'EN_ROUTE' ELSE 'ACCEPTED' END AS status,
    ms + CASE i WHEN 6 THEN 240000 ELSE 4000 END AS ms, ims + CASE i WHEN 6 THEN 240000 ELSE 4000 END AS ims)
FROM once
WHERE (k % 389 = 17 AND i = 2 AND status = 'PREPARING') OR (k % 397 = 23 AND i = 1 AND status = 'ACCEPTED')
    OR (k % 409 = 31 AND status = 'DELIVERED')""",
    "once",
)
_view(
    "order_feed",
    f"""SELECT event_id, 'ord_' || k AS order_id, 'cust_' || c AS customer_id,
    'rest_' || (day * 50 + k * 31 % 50) AS restaurant_id,
    CASE WHEN i >= 1 THEN 'courier_' || (day * 80 + k * 17 % 80) END AS courier_id,
    CASE WHEN k % 97 = 11 THEN 'zone_airport' ELSE {_ZONE.format("c % 6")} END AS zone_id,
    status AS order_status, previous AS previous_status, ms, ims,
    make_timestamp(ms * 1000) AS event_timestamp, make_timestamp(ims * 1000) AS ingestion_timestamp,
    CASE WHEN i = 0 AND k % 307 <> 9 THEN cents END AS order_total_cents,
    CASE WHEN i <= 1 THEN cast(eprep AS int) END AS estimated_prep_time_seconds,
    CASE WHEN i = 0 THEN cast((eprep + 900) * wm // 100 AS int) END
        AS estimated_delivery_time_seconds,
    CASE WHEN i >= 3 AND NOT skipping AND NOT (gone AND cancel_at = 3)
        THEN cast(d2 + d3 AS int) END AS actual_prep_time_seconds,
    CASE WHEN status = 'DELIVERED' THEN cast(el AS int) END AS actual_delivery_time_seconds,
    peak AS is_peak_hour, weather AS weather_condition,
    CASE WHEN status = 'CANCELLED' THEN CASE WHEN pc >= 12 THEN 'NO_COURIER_AVAILABLE'
        WHEN k % 37 = 5 THEN 'NO_REASON' ELSE CASE k % 4 WHEN 0 THEN 'CUSTOMER_REQUEST'
        WHEN 1 THEN 'RESTAURANT_CLOSED' WHEN 2 THEN 'NO_COURIER_AVAILABLE'
        ELSE 'PAYMENT_FAILED' END END END AS cancellation_reason,
    tenths, dup AS is_duplicate, late AS is_late_arrival
FROM (SELECT *, false AS dup FROM rated UNION ALL SELECT *, false AS dup FROM strays UNION ALL
    SELECT * REPLACE (ims + 100 + k % 4901 AS ims), true AS dup
    FROM rated WHERE (k * 11 + i * 3) % 53 = 0)""",
    "rated",
    "strays",
)
_view(
    "pings",
    f"""SELECT e, 'ce_' || e AS event_id, 'courier_' || u AS courier_id,
    CASE WHEN u % 15 = 14 THEN 'zone_airport' ELSE {_ZONE.format("u % 6")} END AS zone_id,
    status AS courier_status,
    CASE WHEN e % 331 = 5 THEN 'LOST' WHEN e % 7 = 0 THEN 'ONLINE_IDLE' END AS previous_status,
    CASE WHEN (a >= 20 AND a < 40) OR status NOT IN ('ONLINE_IDLE', 'OFFLINE')
        THEN 'ord_' || e END AS order_id,
    ms, ms + 50 + e % 1951 + CASE WHEN e % 19 = 0 THEN 30000 + (e * 17 % 270) * 1000 ELSE 0 END AS ims,
    (CASE u % 6 WHEN 0 THEN 40705000 WHEN 1 THEN 40725000 WHEN 2 THEN 40650000
        WHEN 3 THEN 40710000 WHEN 4 THEN 40755000 ELSE 40600000 END
        + off // 1000 + CASE WHEN a < 12 THEN 500000 ELSE 0 END) / 1e6::double AS latitude,
    (CASE u % 6 WHEN 0 THEN -74010000 WHEN 1 THEN -74005000 WHEN 2 THEN -74010000
        WHEN 3 THEN -73970000 WHEN 4 THEN -73990000 ELSE -74050000 END
        + off // 1000) / 1e6::double AS longitude,
    cast(CASE WHEN e % 3 <> 0 THEN (e % 40) / 4 END AS float) AS location_accuracy_meters,
    cast(CASE WHEN e % 5 <> 0 THEN e * 7 % 360 END AS float) AS heading_degrees,
    CASE u % 5 WHEN 0 THEN 'BICYCLE' WHEN 1 THEN 'SCOOTER' WHEN 2 THEN 'MOTORCYCLE'
        WHEN 3 THEN 'CAR' ELSE 'FOOT' END AS vehicle_type,
    CASE WHEN status = 'HEADING_TO_RESTAURANT' THEN cast(e * 13 % 5000 AS int) END
        AS distance_to_restaurant_meters,
    CASE WHEN status = 'EN_ROUTE_TO_CUSTOMER' THEN cast(e * 13 % 5000 AS int) END
        AS distance_to_customer_meters,
    'sess_' || u || '_' || (day * 24 + off // 3600000) AS session_id,
    CASE WHEN e % 10 <> 3 THEN cast(off % 3600000 // 1000 AS int) END AS shift_duration_seconds,
    cast(off % 3600000 // 1000 // 600 AS int) AS deliveries_completed_in_session,
    CASE WHEN a < 12 THEN 'LOCATION_JUMP' WHEN a < 20 THEN 'IMPOSSIBLE_SPEED'
        WHEN a < 40 THEN 'OFFLINE_MID_DELIVERY' WHEN a < 44 THEN 'CLOCK_SKEW'
        WHEN a = 44 THEN 'GHOST' END AS anomaly_flag,
    e % 19 = 0 AS is_late_arrival
FROM (SELECT *, 1704106800000 + day * 86400000 + off AS ms,
        CASE WHEN (a >= 20 AND a < 40) OR e % 61 = 0 THEN 'OFFLINE'
        WHEN t = 'view' THEN 'ONLINE_IDLE' WHEN t = 'click' THEN 'HEADING_TO_RESTAURANT'
        WHEN t = 'signup' THEN 'WAITING_AT_RESTAURANT' WHEN t = 'error' THEN 'EN_ROUTE_TO_CUSTOMER'
        WHEN t = 'purchase' THEN 'DELIVERED' END AS status
    FROM (SELECT event_id AS e, user_id AS u, event_type AS t, event_id * 3 // 10000 AS day,
            (event_id * 7919000 + event_id % 977) % 14400000 AS off, (event_id * 29) % 397 AS a
        FROM events))""",
)
_view(
    "courier_feed",
    """SELECT *, make_timestamp(ms * 1000) AS event_timestamp,
    make_timestamp(ims * 1000) AS ingestion_timestamp
FROM (SELECT *, false AS is_duplicate FROM pings UNION ALL
    SELECT * REPLACE (event_id || '_d' AS event_id, ims + 100 + e % 2901 AS ims),
        true AS is_duplicate
    FROM pings WHERE e % 53 = 7)""",
    "pings",
)
_view(
    "items",
    "SELECT 'ord_' || k AS order_id, item_id, quantity, unit_price_cents FROM basket WHERE k % 313 <> 4",
    "basket",
)

_view(
    "cuts",
    """SELECT ((first + third * (last - first + 1) // 3) * 1440 + minute) * 60000 AS cut
FROM (SELECT min(ms) // 86400000 AS first, max(ms) // 86400000 AS last FROM order_feed)
CROSS JOIN (SELECT unnest([1, 1, 2, 2]) AS third, unnest([757, 761, 831, 835]) AS minute)""",
    "order_feed",
)

# --- the nine windowed analytics ---------------------------------------------

_view(
    "uc1_order_volume",
    f"""SELECT *, CASE WHEN total_orders = 0 THEN 0.0
        ELSE {rounded("cancelled_orders / total_orders * 100", 2)} END AS cancellation_rate
FROM (SELECT {_window()}, zone_id,
        count(*) FILTER (WHERE order_status = 'PLACED') AS total_orders,
        count(*) FILTER (WHERE order_status = 'CANCELLED') AS cancelled_orders
    FROM order_feed WHERE NOT is_duplicate GROUP BY ALL)""",
    "order_feed",
)
_view(
    "uc3_prep_sla",
    f"""SELECT {_window()}, zone_id, restaurant_id, is_peak_hour, count(*) AS breach_count,
    round(avg(actual_prep_time_seconds), 0) AS avg_prep_time_sec,
    max(actual_prep_time_seconds) AS max_prep_time_sec
FROM order_feed
WHERE NOT is_duplicate AND order_status = 'READY_FOR_PICKUP' AND actual_prep_time_seconds > 1200
GROUP BY ALL""",
    "order_feed",
)
_view(
    "uc4_weather",
    f"""SELECT {_window()}, weather_condition, count(*) AS order_count,
    round(avg(actual_delivery_time_seconds), 0) AS avg_delivery_sec,
    min(actual_delivery_time_seconds) AS min_delivery_sec,
    max(actual_delivery_time_seconds) AS max_delivery_sec,
    quantile_disc(actual_delivery_time_seconds, 0.95) AS p95_delivery_sec
FROM order_feed
WHERE NOT is_duplicate AND order_status = 'DELIVERED' AND actual_delivery_time_seconds IS NOT NULL
GROUP BY ALL""",
    "order_feed",
)
_view(
    "uc7_anomalies",
    f"""SELECT *, {rounded("total_anomalies / total_events * 100", 2)} AS anomaly_rate
FROM (SELECT {_window()}, zone_id, vehicle_type, count(*) AS total_events,
        count(anomaly_flag) AS total_anomalies,
        count(*) FILTER (WHERE anomaly_flag = 'IMPOSSIBLE_SPEED') AS impossible_speed,
        count(*) FILTER (WHERE anomaly_flag = 'LOCATION_JUMP') AS location_jump,
        count(*) FILTER (WHERE anomaly_flag = 'OFFLINE_MID_DELIVERY') AS offline_mid_delivery
    FROM courier_feed GROUP BY ALL)""",
    "courier_feed",
)
_view(
    "demand",
    f"""SELECT {_window()}, zone_id, count(*) AS demand_orders
FROM order_feed WHERE NOT is_duplicate AND order_status = 'PLACED' GROUP BY ALL""",
    "order_feed",
)
_view(
    "supply",
    f"""SELECT {_window()}, zone_id, count(DISTINCT courier_id) AS supply_couriers
FROM courier_feed WHERE NOT is_duplicate AND courier_status = 'ONLINE_IDLE' GROUP BY ALL""",
    "courier_feed",
)
_view(
    "uc9_supply_demand",
    f"""SELECT d.window_start, d.window_end, d.window_date, d.zone_id, demand_orders,
    supply_couriers, {rounded("demand_orders / supply_couriers", 2)} AS demand_supply_ratio
FROM demand d JOIN supply s ON d.window_start = s.window_start AND d.zone_id = s.zone_id""",
    "demand",
    "supply",
)
_view(
    "uc10_processing_time",
    f"""SELECT {_window()}, zone_id, count(*) AS order_count,
    round(avg(actual_prep_time_seconds), 0) AS avg_processing_sec,
    min(actual_prep_time_seconds) AS min_processing_sec,
    max(actual_prep_time_seconds) AS max_processing_sec
FROM order_feed
WHERE NOT is_duplicate AND order_status = 'READY_FOR_PICKUP'
    AND actual_prep_time_seconds IS NOT NULL
GROUP BY ALL""",
    "order_feed",
)
_view(
    "uc11_order_value",
    f"""SELECT window_start, window_end, window_date, zone_id, n AS order_count,
    (2 * total + n) // (2 * n) / 100::double AS avg_order_eur, low / 100::double AS min_order_eur,
    high / 100::double AS max_order_eur, total / 100::double AS total_revenue_eur
FROM (SELECT {_window()}, zone_id, count(*) AS n, min(order_total_cents) AS low,
        max(order_total_cents) AS high, cast(sum(order_total_cents) AS bigint) AS total
    FROM order_feed
    WHERE NOT is_duplicate AND order_status = 'PLACED' AND order_total_cents IS NOT NULL
    GROUP BY ALL)""",
    "order_feed",
)
_view(
    "uc12_eta_accuracy",
    f"""SELECT {_window()}, zone_id, weather_condition, count(*) AS order_count,
    round(avg(estimated_delivery_time_seconds), 0) AS avg_eta_sec,
    min(estimated_delivery_time_seconds) AS min_eta_sec,
    max(estimated_delivery_time_seconds) AS max_eta_sec,
    quantile_disc(estimated_delivery_time_seconds, 0.9) AS p90_eta_sec
FROM order_feed
WHERE NOT is_duplicate AND order_status = 'PLACED' AND estimated_delivery_time_seconds IS NOT NULL
GROUP BY ALL""",
    "order_feed",
)
_view(
    "uc13_courier_productivity",
    f"""SELECT window_start, window_end, window_date, zone_id, vehicle_type,
    count(*) AS session_count, {rounded("avg(deliveries)", 2)} AS avg_deliveries,
    quantile_disc(deliveries, 0.5) AS p50_deliveries,
    quantile_disc(deliveries, 0.9) AS p90_deliveries,
    {rounded("avg(seconds) / 60", 1)} AS avg_shift_minutes,
    CASE WHEN sum(seconds) = 0 THEN 0.0
        ELSE {rounded("sum(deliveries) * 3600 / sum(seconds)", 2)} END AS deliveries_per_hour
FROM (SELECT {_window()}, zone_id, vehicle_type, session_id,
        max(deliveries_completed_in_session) AS deliveries, max(shift_duration_seconds) AS seconds
    FROM courier_feed
    WHERE NOT is_duplicate AND shift_duration_seconds IS NOT NULL
        AND deliveries_completed_in_session IS NOT NULL
    GROUP BY ALL)
GROUP BY window_start, window_end, window_date, zone_id, vehicle_type""",
    "courier_feed",
)

# --- rows the quality and order checks build on ------------------------------

_view(
    "history",
    """SELECT *, lag(order_status) OVER (PARTITION BY order_id ORDER BY ms, position) AS from_status
FROM (SELECT order_id, order_status, ms, any_value(zone_id) AS zone_id,
        any_value(is_peak_hour) AS is_peak_hour, any_value(weather_condition) AS weather_condition,
        any_value(list_position(['PLACED', 'ACCEPTED', 'PREPARING', 'READY_FOR_PICKUP', 'PICKED_UP',
            'EN_ROUTE', 'DELIVERED', 'CANCELLED', 'FAILED'], order_status)) AS position
    FROM order_feed WHERE NOT is_duplicate AND tenths IS NULL GROUP BY order_id, order_status, ms)""",
    "order_feed",
)
_view(
    "transitions",
    """SELECT * EXCLUDE (order_status) FROM (SELECT *, order_status AS to_status,
        position - lag(position) OVER w AS stride, (ms - lag(ms) OVER w) // 1000 AS seconds
    FROM history WHERE from_status IS NULL OR from_status <> order_status
    WINDOW w AS (PARTITION BY order_id ORDER BY ms, position))
WHERE from_status IS NOT NULL""",
    "history",
)


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371.0::double * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2)))"
    )


_view(
    "track",
    """SELECT courier_id, session_id, ms, min(event_id) AS event_id,
    arg_min(latitude, event_id) AS lat, arg_min(longitude, event_id) AS lon,
    arg_min(vehicle_type, event_id) AS vehicle_type,
    coalesce(bool_or(anomaly_flag = 'LOCATION_JUMP'), false) AS labelled_jump,
    coalesce(bool_or(anomaly_flag = 'IMPOSSIBLE_SPEED'), false) AS labelled_speed
FROM courier_feed WHERE NOT is_duplicate GROUP BY courier_id, session_id, ms""",
    "courier_feed",
)
_view(
    "judged",
    f"""SELECT *, coalesce(kmh > top AND CASE WHEN ms2 IS NULL
        THEN NOT coalesce(back_kmh <= top, false) ELSE skip_kmh <= top END, false) AS detected
FROM (SELECT *, CASE vehicle_type WHEN 'BICYCLE' THEN 25 WHEN 'SCOOTER' THEN 45
            WHEN 'MOTORCYCLE' THEN 80 WHEN 'CAR' THEN 90 WHEN 'FOOT' THEN 8 END AS top,
        {haversine("lat1", "lon1", "lat", "lon")} * 3.6e6 / (ms - ms1) AS kmh,
        {haversine("lat1", "lon1", "lat2", "lon2")} * 3.6e6 / (ms2 - ms1) AS skip_kmh,
        {haversine("lat0", "lon0", "lat", "lon")} * 3.6e6 / (ms - ms0) AS back_kmh
    FROM (SELECT *, lag(lat) OVER w AS lat1, lag(lon) OVER w AS lon1, lag(ms) OVER w AS ms1,
            lag(lat, 2) OVER w AS lat0, lag(lon, 2) OVER w AS lon0, lag(ms, 2) OVER w AS ms0,
            lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2, lead(ms) OVER w AS ms2
        FROM track WINDOW w AS (PARTITION BY courier_id, session_id ORDER BY ms)))""",
    "track",
)
_view(
    "promise_errors",
    """SELECT p.order_id, p.zone_id, p.weather_condition, promised_seconds, actual_seconds,
    actual_seconds - promised_seconds AS error_seconds
FROM (SELECT order_id, zone_id, weather_condition, min(ms) AS placed,
        max(estimated_delivery_time_seconds) AS promised_seconds
    FROM order_feed WHERE NOT is_duplicate AND order_status = 'PLACED'
        AND estimated_delivery_time_seconds IS NOT NULL GROUP BY ALL) p
LEFT JOIN (SELECT order_id, min(ms) AS done, arg_min(actual_delivery_time_seconds, ms) AS actual_seconds
    FROM order_feed WHERE NOT is_duplicate AND order_status = 'DELIVERED' AND tenths IS NULL
    GROUP BY order_id) d ON p.order_id = d.order_id AND done - placed <= 6 * 3600000""",
    "order_feed",
)


def _ordered(names: tuple[str, ...], done: list[str]) -> list[str]:
    for name in names:
        if name not in done:
            _ordered(NEEDS[name], done)
            done.append(name)
    return done


def statement(query: str, *needs: str) -> str:
    """A complete statement: the views ``needs`` asks for, then the query."""
    views = _ordered(needs, [])
    if not views:
        return query
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in views) + "\n" + query
