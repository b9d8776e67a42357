"""Schemas of the two event feeds and of the nine result tables.

The feeds are always read with these explicit schemas; nothing is inferred.
``avro_schema`` renders a feed schema for Spark's Avro functions.
"""

from __future__ import annotations

import json

from pyspark.sql import types as T

from . import dimensions as dim

SCHEMA_VERSION = "1.1.0"

ORDER_ITEM = T.StructType(
    [
        T.StructField("item_id", T.StringType(), False),
        T.StructField("item_name", T.StringType(), False),
        T.StructField("quantity", T.IntegerType(), False),
        T.StructField("unit_price_cents", T.IntegerType(), False),
    ]
)


def _field(name, spark_type, nullable=False, **metadata):
    return T.StructField(name, spark_type, nullable, metadata)


def _enum(name, symbols, nullable=False):
    return _field(name, T.StringType(), nullable, symbols=list(symbols))


_METADATA = _field("metadata", T.MapType(T.StringType(), T.StringType()), True)

ORDER_FEED = T.StructType(
    [
        _field("schema_version", T.StringType()),
        _field("event_id", T.StringType()),
        _field("order_id", T.StringType()),
        _field("customer_id", T.StringType()),
        _field("restaurant_id", T.StringType()),
        _field("courier_id", T.StringType(), True),
        _field("zone_id", T.StringType()),
        _enum("order_status", dim.ORDER_STATUSES),
        _enum("previous_status", dim.ORDER_STATUSES, True),
        _field("event_timestamp", T.TimestampType()),
        _field("ingestion_timestamp", T.TimestampType()),
        _field("order_items", T.ArrayType(ORDER_ITEM, False), True),
        # an int on the wire; wider here so that no total can overflow
        _field("order_total_cents", T.LongType(), True, avro="int"),
        _field("estimated_prep_time_seconds", T.IntegerType(), True),
        _field("estimated_delivery_time_seconds", T.IntegerType(), True),
        _field("actual_prep_time_seconds", T.IntegerType(), True),
        _field("actual_delivery_time_seconds", T.IntegerType(), True),
        _field("is_peak_hour", T.BooleanType()),
        _enum("weather_condition", dim.WEATHER_CONDITIONS),
        _enum("cancellation_reason", dim.CANCELLATION_REASONS, True),
        _field("customer_rating", T.FloatType(), True),
        _field("is_duplicate", T.BooleanType()),
        _field("is_late_arrival", T.BooleanType()),
        _METADATA,
    ]
)

COURIER_FEED = T.StructType(
    [
        _field("schema_version", T.StringType()),
        _field("event_id", T.StringType()),
        _field("courier_id", T.StringType()),
        _field("order_id", T.StringType(), True),
        _field("zone_id", T.StringType()),
        _enum("courier_status", dim.COURIER_STATUSES),
        _enum("previous_status", dim.COURIER_STATUSES, True),
        _field("event_timestamp", T.TimestampType()),
        _field("ingestion_timestamp", T.TimestampType()),
        _field("latitude", T.DoubleType()),
        _field("longitude", T.DoubleType()),
        _field("location_accuracy_meters", T.FloatType(), True),
        _field("heading_degrees", T.FloatType(), True),
        _enum("vehicle_type", dim.VEHICLE_TYPES),
        _field("distance_to_restaurant_meters", T.IntegerType(), True),
        _field("distance_to_customer_meters", T.IntegerType(), True),
        _field("session_id", T.StringType()),
        _field("shift_duration_seconds", T.IntegerType(), True),
        _field("deliveries_completed_in_session", T.IntegerType()),
        _field("is_duplicate", T.BooleanType()),
        _field("is_late_arrival", T.BooleanType()),
        _enum("anomaly_flag", dim.ANOMALY_FLAGS, True),
        _METADATA,
    ]
)


def enum_columns(feed: T.StructType) -> dict[str, list[str]]:
    """Allowed symbols of each enum column of a feed schema."""
    return {f.name: f.metadata["symbols"] for f in feed if "symbols" in f.metadata}


def as_nullable(feed: T.StructType) -> T.StructType:
    """The same columns, all nullable: what a file source can really promise."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in feed])


# --- result tables -----------------------------------------------------------

_WINDOW = "window_start timestamp, window_end timestamp, window_date date, "

RESULTS = {
    "uc1_order_volume": _WINDOW
    + "zone_id string, total_orders bigint, cancelled_orders bigint, cancellation_rate double",
    "uc3_prep_sla": _WINDOW
    + "zone_id string, restaurant_id string, is_peak_hour boolean, breach_count bigint, "
    "avg_prep_time_sec double, max_prep_time_sec int",
    "uc4_weather": _WINDOW
    + "weather_condition string, order_count bigint, avg_delivery_sec double, "
    "min_delivery_sec int, max_delivery_sec int, p95_delivery_sec int",
    "uc7_anomalies": _WINDOW
    + "zone_id string, vehicle_type string, total_events bigint, total_anomalies bigint, "
    "anomaly_rate double, impossible_speed bigint, location_jump bigint, "
    "offline_mid_delivery bigint",
    "uc9_supply_demand": _WINDOW
    + "zone_id string, demand_orders bigint, supply_couriers bigint, demand_supply_ratio double",
    "uc10_processing_time": _WINDOW
    + "zone_id string, order_count bigint, avg_processing_sec double, "
    "min_processing_sec int, max_processing_sec int",
    "uc11_order_value": _WINDOW
    + "zone_id string, order_count bigint, avg_order_eur double, min_order_eur double, "
    "max_order_eur double, total_revenue_eur double",
    "uc12_eta_accuracy": _WINDOW
    + "zone_id string, weather_condition string, order_count bigint, avg_eta_sec double, "
    "min_eta_sec int, max_eta_sec int, p90_eta_sec int",
    "uc13_courier_productivity": _WINDOW
    + "zone_id string, vehicle_type string, session_count bigint, avg_deliveries double, "
    "p50_deliveries int, p90_deliveries int, avg_shift_minutes double, deliveries_per_hour double",
}


#: results kept as sketches, to be merged over windows
SKETCHES = {
    "delivery_sketches": _WINDOW + "weather_condition string, value_count bigint, sketch binary",
    "promise_sketches": _WINDOW
    + "zone_id string, weather_condition string, value_count bigint, sketch binary",
    "productivity_sketches": _WINDOW
    + "zone_id string, vehicle_type string, value_count bigint, sketch binary",
    "idle_sketches": _WINDOW + "zone_id string, sketch binary",
}


def result_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL((RESULTS | SKETCHES)[name])


# --- Avro rendering ----------------------------------------------------------

_AVRO_PRIMITIVES = {
    T.StringType: "string",
    T.IntegerType: "int",
    T.LongType: "long",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.BooleanType: "boolean",
}


def _avro_type(field: T.StructField):
    kind = field.dataType
    if "symbols" in field.metadata:
        name = "".join(part.title() for part in field.name.split("_"))
        return {"type": "enum", "name": name, "symbols": field.metadata["symbols"]}
    if "avro" in field.metadata:
        return field.metadata["avro"]
    if isinstance(kind, T.TimestampType):
        return {"type": "long", "logicalType": "timestamp-millis"}
    if isinstance(kind, T.MapType):
        return {"type": "map", "values": "string"}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": _avro_record("OrderItem", kind.elementType)}
    return _AVRO_PRIMITIVES[type(kind)]


def _avro_record(name: str, struct: T.StructType) -> dict:
    fields = []
    for f in struct:
        avro = _avro_type(f)
        if f.nullable:
            fields.append({"name": f.name, "type": ["null", avro], "default": None})
        else:
            fields.append({"name": f.name, "type": avro})
    return {"type": "record", "name": name, "fields": fields}


def avro_schema(feed: T.StructType) -> str:
    """Avro schema (JSON text) with the wire layout of a feed."""
    name = "OrderLifecycleEvent" if "order_status" in feed.fieldNames() else "CourierStatusEvent"
    return json.dumps(_avro_record(name, feed))


def avro_columns(feed: T.StructType) -> T.StructType:
    """The feed's columns, nullable, with the types they have on the wire."""
    wire = {"int": T.IntegerType()}
    return T.StructType(
        [T.StructField(f.name, wire.get(f.metadata.get("avro"), f.dataType)) for f in feed]
    )
