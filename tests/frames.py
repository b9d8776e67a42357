"""Small hand-made feeds: every column has a default, tests set what matters."""

from datetime import datetime, timedelta

from dispatchlens.schemas import COURIER_FEED, ORDER_FEED, as_nullable

NOON = datetime(2024, 1, 1, 12, 0, 0)

ORDER = {
    "schema_version": "1.1.0",
    "order_id": "ord_1",
    "customer_id": "cust_1",
    "restaurant_id": "rest_1",
    "zone_id": "zone_west",
    "order_status": "PLACED",
    "is_peak_hour": True,
    "weather_condition": "CLEAR",
    "is_duplicate": False,
    "is_late_arrival": False,
}
COURIER = {
    "schema_version": "1.1.0",
    "courier_id": "courier_1",
    "zone_id": "zone_west",
    "courier_status": "ONLINE_IDLE",
    "latitude": 40.66,
    "longitude": -74.0,
    "vehicle_type": "BICYCLE",
    "session_id": "sess_1",
    "shift_duration_seconds": 60,
    "deliveries_completed_in_session": 1,
    "is_duplicate": False,
    "is_late_arrival": False,
}


def at(seconds):
    return NOON + timedelta(seconds=seconds)


def _feed(spark, schema, defaults, rows):
    full = []
    for i, row in enumerate(rows):
        row = {"event_id": f"e{i:05d}", **defaults, **row}
        row["event_timestamp"] = at(row.pop("t", 0))
        row["ingestion_timestamp"] = row["event_timestamp"] + timedelta(
            milliseconds=row.pop("lag_ms", 100)
        )
        unknown = set(row) - set(schema.fieldNames())
        assert not unknown, unknown
        full.append(tuple(row.get(name) for name in schema.fieldNames()))
    return spark.createDataFrame(full, as_nullable(schema))


def orders(spark, *rows):
    return _feed(spark, ORDER_FEED, ORDER, rows)


def couriers(spark, *rows):
    return _feed(spark, COURIER_FEED, COURIER, rows)


def result(spark, name, *rows):
    """Rows of a result table; the window is given as minute ``m`` after noon."""
    from dispatchlens.schemas import result_schema

    schema = result_schema(name)
    full = []
    for row in rows:
        row = dict(row)
        start = NOON + timedelta(minutes=row.pop("m", 0))
        row |= {
            "window_start": start,
            "window_end": start + timedelta(minutes=1),
            "window_date": start.date(),
        }
        full.append(tuple(row.get(n) for n in schema.fieldNames()))
    return spark.createDataFrame(full, schema)
