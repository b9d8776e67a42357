"""The two event feeds, derived from the given tables as test input.

Every feed column is integer arithmetic on a table row, so that any SQL engine can rebuild the
same feed (see ``views``).  One row fans out into its events with explode; copies and duplicates
come out of the same pass, and nothing is joined or shuffled.  Days, couriers, restaurants and
items grow with the tables.

The feeds hold what the checks look for: a zone that is not listed, values outside their enums,
steps that are too short or too long, a delivery after seven hours, couriers that vanish, totals
off by a cent, orders without items or total, statuses that come back, repeat or follow the end, and
events up to 300 seconds late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dispatchlens.dimensions import LIFECYCLE, ZONE_IDS
from dispatchlens.schemas import COURIER_FEED, ORDER_FEED, SCHEMA_VERSION

START_MS = 1_704_106_800_000  # 2024-01-01 11:00:00 UTC
DAY_MS = 86_400_000

# only what the feeds need, so that scans stay narrow
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string",
    "part": "p_partkey bigint, p_name string",
    "events": "event_id bigint, user_id bigint, event_type string",
}

_ZONES = "array(" + ", ".join(f"'{z}'" for z in ZONE_IDS) + ")"
_STATES = "array(" + ", ".join(f"'{s}'" for s in LIFECYCLE) + ")"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _as_feed(df: DataFrame, schema: T.StructType, columns: dict[str, str]) -> DataFrame:
    """All columns of the feed in order; those the derivation lacks are null."""
    return df.selectExpr(
        *[
            f"cast({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema
        ]
    )


def item_names(part: DataFrame) -> DataFrame:
    return part.selectExpr("concat('item_', p_partkey) AS item_id", "p_name AS item_name")


def _delay(step: int) -> str:
    """Seconds from the status before to the one at ``step``."""
    usual = f"d{step}"
    if step == 3:
        usual = "if(skipping, 0, d3)"
    if step == 4:
        usual = "if(skipping, 30 + a1, d4)"
    return f"if(gone AND cancel_at = {step}, if(pc < 12, 30 + a1, vz), {usual})"


def derive_orders(orders: DataFrame) -> DataFrame:
    """Order feed from the orders table."""
    drawn = orders.selectExpr(
        "o_orderkey AS k",
        "o_custkey AS c",
        "cast(substring(o_orderpriority, 1, 1) AS int) AS pr",
    ).selectExpr(
        "*",
        "k div 5000 AS day",
        "(k * 7919) % 14400 AS off_s",
        "(k * 31) % 91 AS a1",
        "(k * 37) % 51 AS a2",
        "(k * 6131) % 1021 AS a3",
        "(k * 541) % 541 AS a4",
        "(k * 3571) % 1501 AS a5",
        "300 + (k * 17) % 601 AS vz",
        "(k * 53) % 97 AS pc",
        "(k * 67) % 103 AS rt",
        "(k * 1009) % 1201 AS ep",
        "(k * 71) % 107 AS skip",
        "CASE WHEN k % 499 = 3 THEN 'FOG' WHEN pr = 3 THEN 'RAIN' WHEN pr = 4 THEN 'HEAVY_RAIN'"
        " WHEN pr = 5 THEN 'SNOW' ELSE 'CLEAR' END AS weather",
        "CASE WHEN k % 499 = 3 THEN 100 WHEN pr = 3 THEN 120 WHEN pr = 4 THEN 145"
        " WHEN pr = 5 THEN 160 ELSE 100 END AS wm",
        "transform(sequence(0, cast(k % 4 AS int)), j -> named_struct("
        "'item_id', concat('item_', k div 8 + j * 5),"
        " 'item_name', concat('Dish ', (k div 8 + j * 5) % 60),"
        " 'quantity', cast((k + j) % 3 + 1 AS int),"
        " 'unit_price_cents', cast(300 + (k * 7 + j * 11) % 1500 AS int))) AS basket",
    )
    timed = drawn.selectExpr(
        "*",
        "off_s div 3600 + 11 IN (12, 13, 14, 19, 20, 21) AS peak",
        "CASE WHEN off_s div 3600 + 11 IN (12, 13, 14, 19, 20, 21) THEN 14 ELSE 10 END AS pm",
        "pc < 14 AS gone",
        "if(pc < 12, (k * 13) % 4 + 1, 5) AS cancel_at",
        "pc >= 14 AND skip < 3 AS skipping",
        "aggregate(basket, 0L, (s, x) -> s + x.quantity * x.unit_price_cents)"
        " + if(k % 211 = 5, 1, 0) AS cents",
    )
    steps = timed.selectExpr(
        "*",
        "if(k % 401 = 7, 3, 30 + a1) AS d1",
        "10 + a2 AS d2",
        "(480 + a3) * pm div 10 AS d3",
        "if(k % 401 = 8, 9000, 60 + a4) AS d4",
        "5 + a2 % 26 AS d5",
        "if(k % 401 = 9, 25200, (300 + a5) * wm div 100) AS d6",
        "(600 + ep) * pm div 10 AS eprep",
        "explode(array(0, 1, 2, 3, 4, 5, 6)) AS i",
    ).filter("(gone AND i <= cancel_at) OR (NOT gone AND NOT (skipping AND i = 3))")
    events = steps.selectExpr(
        "*",
        f"CASE WHEN gone AND i = cancel_at THEN 'CANCELLED' ELSE {_STATES}[i] END AS status",
        f"CASE WHEN i = 0 THEN NULL WHEN i = 4 AND skipping THEN {_STATES}[2] "
        f"ELSE {_STATES}[i - 1] END AS previous",
        " + ".join(f"if(i >= {j}, {_delay(j)}, 0)" for j in range(1, 7)) + " AS el",
    )
    # variant 1 is the rating copy, 2 the duplicate, 3 the duplicate of the copy, 4 an event more: ACCEPTED
    # again after PREPARING or after itself, or EN_ROUTE after DELIVERED
    variants = events.selectExpr(
        "*",
        "(k % 389 = 17 AND i = 2 AND status = 'PREPARING') OR (k % 397 = 23 AND i = 1 AND status = 'ACCEPTED')"
        " OR (k % 409 = 31 AND status = 'DELIVERED') AS stray",
    ).selectExpr(
        "* EXCEPT (stray)",
        "explode(concat(if(stray, array(4), array()), CASE"
        " WHEN status = 'DELIVERED' AND rt < 65 AND (k * 11 + i * 3) % 53 = 0"
        " THEN array(0, 1, 2, 3)"
        " WHEN status = 'DELIVERED' AND rt < 65 THEN array(0, 1)"
        " WHEN (k * 11 + i * 3) % 53 = 0 THEN array(0, 2)"
        " ELSE array(0) END)) AS v",
    ).selectExpr(
        "* EXCEPT (status, previous)",
        "CASE WHEN v <> 4 THEN status WHEN i = 6 THEN 'EN_ROUTE' ELSE 'ACCEPTED' END AS status",
        "if(v = 4, status, previous) AS previous",
        "v IN (1, 3) AS rated",
        "v IN (2, 3) AS dup",
        f"{START_MS} + day * {DAY_MS} + (off_s + el + CASE WHEN v <> 4 THEN 0 WHEN i = 6 THEN 240 ELSE 4 END)"
        " * 1000 AS ms",
        "(k * 7 + i) % 19 = 0 AS late",
    )
    return _as_feed(
        variants,
        ORDER_FEED,
        {
            "schema_version": f"'{SCHEMA_VERSION}'",
            "event_id": "concat('oe_', k, '_', i, CASE WHEN rated THEN '_r' WHEN v = 4 THEN '_x' ELSE '' END)",
            "order_id": "concat('ord_', k)",
            "customer_id": "concat('cust_', c)",
            "restaurant_id": "concat('rest_', day * 50 + k * 31 % 50)",
            "courier_id": "if(i >= 1, concat('courier_', day * 80 + k * 17 % 80), NULL)",
            "zone_id": f"if(k % 97 = 11, 'zone_airport', {_ZONES}[cast(c % 6 AS int)])",
            "order_status": "status",
            "previous_status": "previous",
            "event_timestamp": "timestamp_millis(ms + if(rated, (60 + k % 3541) * 1000, 0))",
            "ingestion_timestamp": "timestamp_millis(ms + if(late, 30000 + (k * 17 % 270) * 1000, 50 + k % 1951)"
            " + if(dup, 100 + k % 4901, 0))",
            "order_items": "if(i = 0 AND k % 313 <> 4, basket, NULL)",
            "order_total_cents": "if(i = 0 AND k % 307 <> 9, cents, NULL)",
            "estimated_prep_time_seconds": "if(i <= 1, eprep, NULL)",
            "estimated_delivery_time_seconds": "if(i = 0, (eprep + 900) * wm div 100, NULL)",
            "actual_prep_time_seconds": "if(i >= 3 AND NOT skipping AND NOT (gone AND cancel_at = 3), d2 + d3, NULL)",
            "actual_delivery_time_seconds": "if(status = 'DELIVERED', el, NULL)",
            "is_peak_hour": "peak",
            "weather_condition": "weather",
            "cancellation_reason": "CASE WHEN status <> 'CANCELLED' THEN NULL"
            " WHEN pc >= 12 THEN 'NO_COURIER_AVAILABLE' WHEN k % 37 = 5 THEN 'NO_REASON'"
            " ELSE array('CUSTOMER_REQUEST', 'RESTAURANT_CLOSED',"
            " 'NO_COURIER_AVAILABLE', 'PAYMENT_FAILED')[cast(k % 4 AS int)] END",
            "customer_rating": "if(rated, (10 + k % 41) / 10D, NULL)",
            "is_duplicate": "dup",
            "is_late_arrival": "late OR rated",
        },
    )


def derive_couriers(events: DataFrame) -> DataFrame:
    """Courier feed from the events table."""
    drawn = events.selectExpr(
        "event_id AS e",
        "user_id AS u",
        "event_type AS t",
        "event_id * 3 div 10000 AS day",
        "(event_id % 14400000 * 7919000 + event_id % 977) % 14400000 AS off",
        "(event_id * 29) % 397 AS a",
        "cast(user_id % 6 AS int) AS z",
    )
    placed = drawn.selectExpr(
        "*",
        "a >= 20 AND a < 40 AS vanished",
        "CASE WHEN (a >= 20 AND a < 40) OR e % 61 = 0 THEN 'OFFLINE'"
        " WHEN t = 'view' THEN 'ONLINE_IDLE'"
        " WHEN t = 'click' THEN 'HEADING_TO_RESTAURANT'"
        " WHEN t = 'signup' THEN 'WAITING_AT_RESTAURANT'"
        " WHEN t = 'error' THEN 'EN_ROUTE_TO_CUSTOMER'"
        " WHEN t = 'purchase' THEN 'DELIVERED' END AS status",
        f"{START_MS} + day * {DAY_MS} + off AS ms",
        "off % 3600000 div 1000 AS sh",
        "array(40705000, 40725000, 40650000, 40710000, 40755000, 40600000)[z]"
        " + off div 1000 + if(a < 12, 500000, 0) AS lat_e6",
        "array(-74010000, -74005000, -74010000, -73970000, -73990000, -74050000)[z]"
        " + off div 1000 AS lon_e6",
        "e % 19 = 0 AS late",
        "explode(if(e % 53 = 7, array(false, true), array(false))) AS dup",
    )
    return _as_feed(
        placed,
        COURIER_FEED,
        {
            "schema_version": f"'{SCHEMA_VERSION}'",
            "event_id": "concat('ce_', e, if(dup, '_d', ''))",
            "courier_id": "concat('courier_', u)",
            "order_id": "if(vanished OR status NOT IN ('ONLINE_IDLE', 'OFFLINE'), concat('ord_', e), NULL)",
            "zone_id": f"if(u % 15 = 14, 'zone_airport', {_ZONES}[z])",
            "courier_status": "status",
            "previous_status": "CASE WHEN e % 331 = 5 THEN 'LOST' WHEN e % 7 = 0 THEN 'ONLINE_IDLE' END",
            "event_timestamp": "timestamp_millis(ms)",
            "ingestion_timestamp": "timestamp_millis(ms + 50 + e % 1951"
            " + if(late, 30000 + (e * 17 % 270) * 1000, 0)"
            " + if(dup, 100 + e % 2901, 0))",
            "latitude": "lat_e6 / 1e6D",
            "longitude": "lon_e6 / 1e6D",
            "location_accuracy_meters": "if(e % 3 = 0, NULL, (e % 40) / 4D)",
            "heading_degrees": "if(e % 5 = 0, NULL, e * 7 % 360)",
            "vehicle_type": "array('BICYCLE', 'SCOOTER', 'MOTORCYCLE', 'CAR', 'FOOT')[cast(u % 5 AS int)]",
            "distance_to_restaurant_meters": "if(status = 'HEADING_TO_RESTAURANT', e * 13 % 5000, NULL)",
            "distance_to_customer_meters": "if(status = 'EN_ROUTE_TO_CUSTOMER', e * 13 % 5000, NULL)",
            "session_id": "concat('sess_', u, '_', day * 24 + off div 3600000)",
            "shift_duration_seconds": "if(e % 10 <> 3, sh, NULL)",
            "deliveries_completed_in_session": "sh div 600",
            "is_duplicate": "dup",
            "is_late_arrival": "late",
            "anomaly_flag": "CASE WHEN a < 12 THEN 'LOCATION_JUMP' WHEN a < 20 THEN 'IMPOSSIBLE_SPEED'"
            " WHEN a < 40 THEN 'OFFLINE_MID_DELIVERY' WHEN a < 44 THEN 'CLOCK_SKEW'"
            " WHEN a = 44 THEN 'GHOST' END",
        },
    )


def order_feed(spark: SparkSession, folder: str) -> DataFrame:
    return derive_orders(read_table(spark, folder, "orders"))


def courier_feed(spark: SparkSession, folder: str) -> DataFrame:
    return derive_couriers(read_table(spark, folder, "events"))


def _dealt(table: DataFrame, always: bool) -> DataFrame:
    """A table of few splits, dealt to all cores of the session while it is narrow.

    A split of a file may hold no row group, so that as many splits as cores don't keep them all busy.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    if not always and table.rdd.getNumPartitions() >= 2 * cores:
        return table
    return table.repartition(cores, table.columns[0])


def feeds(spark: SparkSession, folder: str, always: bool = False) -> dict[str, DataFrame]:
    """Both feeds, by name, to be written out: a row becomes many events, and all cores make them.

    ``always``: tables of many splits are dealt as well, so that each task has events of all times.
    """
    return {
        "orders": derive_orders(_dealt(read_table(spark, folder, "orders"), always)),
        "couriers": derive_couriers(_dealt(read_table(spark, folder, "events"), always)),
    }
