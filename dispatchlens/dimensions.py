"""Fixed reference data of the delivery platform.

Everything in this module is a fixed value of the feed contract: enum symbols
(in wire order), zones, multipliers, weights and step bounds.  The tables are
small and constant, so operators fold them into the plan as CASE or literal
expressions and never join them.
"""

from __future__ import annotations

from typing import NamedTuple

# --- fixed values: enum symbols, in wire order -------------------------------

ORDER_STATUSES = (
    "PLACED",
    "ACCEPTED",
    "PREPARING",
    "READY_FOR_PICKUP",
    "PICKED_UP",
    "EN_ROUTE",
    "DELIVERED",
    "CANCELLED",
    "FAILED",
)
WEATHER_CONDITIONS = ("CLEAR", "RAIN", "HEAVY_RAIN", "SNOW")
CANCELLATION_REASONS = (
    "CUSTOMER_REQUEST",
    "RESTAURANT_CLOSED",
    "RESTAURANT_REJECTED",
    "NO_COURIER_AVAILABLE",
    "PAYMENT_FAILED",
    "ITEM_UNAVAILABLE",
    "FRAUD_DETECTED",
    "SYSTEM_ERROR",
)
COURIER_STATUSES = (
    "ONLINE_IDLE",
    "HEADING_TO_RESTAURANT",
    "WAITING_AT_RESTAURANT",
    "PICKED_UP",
    "EN_ROUTE_TO_CUSTOMER",
    "DELIVERED",
    "OFFLINE",
    "BREAK",
)
VEHICLE_TYPES = ("BICYCLE", "SCOOTER", "MOTORCYCLE", "CAR", "FOOT")
ANOMALY_FLAGS = (
    "IMPOSSIBLE_SPEED",
    "LOCATION_JUMP",
    "OFFLINE_MID_DELIVERY",
    "CLOCK_SKEW",
    "DUPLICATE_PING",
)

# --- fixed values: order lifecycle -------------------------------------------

LIFECYCLE = ORDER_STATUSES[:7]

# Besides each step to the next one, an order may be cancelled from its first
# four states, or after pickup when its courier vanishes.
CANCELLABLE = LIFECYCLE[:5]


# seconds each step from one lifecycle status to the next may take, in order
class StepBounds(NamedTuple):
    from_status: str
    to_status: str
    low_seconds: int
    high_seconds: int


STEP_BOUNDS = (
    StepBounds("PLACED", "ACCEPTED", 30, 120),
    StepBounds("ACCEPTED", "PREPARING", 10, 60),
    StepBounds("PREPARING", "READY_FOR_PICKUP", 480, 1500),
    StepBounds("READY_FOR_PICKUP", "PICKED_UP", 60, 600),
    StepBounds("PICKED_UP", "EN_ROUTE", 5, 30),
    StepBounds("EN_ROUTE", "DELIVERED", 300, 1800),
)
OTHER_STEP_BOUNDS = (30, 120)
# an order whose courier vanished after pickup is cancelled after so many seconds
VANISHED_BOUNDS = (300, 900)

# --- fixed values: demand and weather ----------------------------------------

PEAK_HOURS = (12, 13, 14, 19, 20, 21)
PEAK_PREP_PERCENT = 140
HANDOVER_SECONDS = 900
WEATHER_PERCENT = {"CLEAR": 100, "RAIN": 120, "HEAVY_RAIN": 145, "SNOW": 160}

# demand weight in hundredths, for integer arithmetic, by hour of the day 0..23
HOURLY_WEIGHT = (
    10, 5, 3, 2, 2, 5, 15, 35, 50, 40, 35, 70,
    180, 200, 120, 80, 70, 100, 180, 220, 200, 150, 90, 40,
)
WEEKEND_PERCENT = 125

PREP_SLA_SECONDS = 1200
SURGE_RATIO = 3.0
LATE_LAG_MS = 30_000
# events come up to 300 seconds late, their copies up to 5 seconds after them
FEED_LATENESS = "305 seconds"
PROMISE_HORIZON_SECONDS = 6 * 3600

# --- fixed values: geography and vehicles ------------------------------------


class Zone(NamedTuple):
    zone_id: str
    lat_lo: float
    lat_hi: float
    lon_lo: float
    lon_hi: float


ZONES = (
    Zone("zone_downtown", 40.7050, 40.7250, -74.0100, -73.9900),
    Zone("zone_midtown", 40.7250, 40.7550, -74.0050, -73.9750),
    Zone("zone_west", 40.6500, 40.7000, -74.0100, -73.9600),
    Zone("zone_east", 40.7100, 40.7450, -73.9700, -73.9400),
    Zone("zone_uptown", 40.7550, 40.7900, -73.9900, -73.9500),
    Zone("zone_suburbs", 40.6000, 40.6500, -74.0500, -73.9000),
)
ZONE_IDS = tuple(z.zone_id for z in ZONES)

VEHICLE_MAX_KMH = {"BICYCLE": 25, "SCOOTER": 45, "MOTORCYCLE": 80, "CAR": 90, "FOOT": 8}
EARTH_RADIUS_KM = 6371.0
