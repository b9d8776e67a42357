"""Neighbour lookup against brute force, jump detection, zones."""

import math
import random

import pytest
from frames import couriers
from pyspark.sql import functions as F

from dispatchlens.functions.domain import haversine_km, zone_at
from dispatchlens.functions.neighbours import with_neighbours
from dispatchlens.operators import motion as M


@pytest.mark.parametrize("slice_millis", [1, 50, 1000, 10_000_000])
def test_neighbours_equal_brute_force(spark, slice_millis):
    random.seed(3)
    # one key holds most rows, others have one to five
    points = {"hot": sorted(random.sample(range(5000), 400))}
    points |= {f"k{i}": sorted(random.sample(range(5000), 1 + i % 5)) for i in range(40)}
    rows = spark.createDataFrame([(k, ms) for k, v in points.items() for ms in v], "k string, ms long")
    found = with_neighbours(
        rows.withColumn("value", F.struct("ms")),
        ["k"],
        "ms",
        "value",
        {"previous": -1, "next": 1, "earlier": -2},
        slice_millis,
    )
    got = {
        (r.k, r.ms): tuple(v and v.ms for v in (r.previous, r.next, r.earlier))
        for r in found.collect()
    }
    want = {}
    for key, times in points.items():
        around = zip([None, *times], times, [*times[1:], None], [None, None, *times])
        for before, ms, after, earlier in around:
            want[key, ms] = (before, after, earlier)
    assert got == want
    assert found.count() == len(want)


def test_haversine(spark):
    pairs = [(40.7, -74.0, 40.7, -74.0), (0.0, 0.0, 0.0, 180.0), (40.7, -74.0, 41.0, -73.5)]
    frame = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    found = [r[0] for r in frame.select(haversine_km(*map(F.col, "abcd"))).collect()]

    def brute(lat1, lon1, lat2, lon2):
        p, q = math.radians(lat1), math.radians(lat2)
        h = math.sin((q - p) / 2) ** 2
        h += math.cos(p) * math.cos(q) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(h))

    assert found == pytest.approx([brute(*p) for p in pairs])


def test_zone_boxes_are_half_open(spark):
    frame = spark.createDataFrame(
        [(40.725, -74.0), (40.7249, -74.0), (40.65, -74.0), (40.5, -74.0)], "lat double, lon double"
    )
    found = [r[0] for r in frame.select(zone_at(F.col("lat"), F.col("lon"))).collect()]
    assert found == ["zone_midtown", "zone_downtown", "zone_west", None]


def ride(*latitudes, every=60, **more):
    return [{"t": i * every, "latitude": lat, **more} for i, lat in enumerate(latitudes)]


def test_jump_is_flagged_once_and_not_its_return(spark):
    feed = couriers(spark, *ride(40.660, 40.661, 41.2, 40.662, 40.663))
    (jump,) = M.location_jumps(feed).collect()
    assert jump.event_id == "e00002" and jump.implied_kmh > 1000


def test_move_for_good_is_no_jump(spark):
    # faster than a bicycle, and the courier stays there
    assert M.location_jumps(couriers(spark, *ride(40.66, 41.2, 41.2, 41.2))).count() == 0


def test_last_point_of_a_track_can_be_a_jump(spark):
    assert M.location_jumps(couriers(spark, *ride(40.66, 40.66, 41.2))).count() == 1


def test_return_at_the_end_of_a_track_is_no_jump(spark):
    (jump,) = M.location_jumps(couriers(spark, *ride(40.66, 41.2, 40.66))).collect()
    assert jump.event_id == "e00001"


def test_vehicle_limit_and_sessions(spark):
    # about 60 km/h: too fast for a bicycle, fine for a car
    fast = (40.66, 40.669, 40.66)
    feed = couriers(
        spark,
        *ride(*fast, session_id="bike"),
        *ride(*fast, session_id="car", vehicle_type="CAR"),
        *ride(40.66, session_id="one"),
        *ride(41.2, session_id="two"),
    )
    assert [r.session_id for r in M.location_jumps(feed).collect()] == ["bike"]


def test_same_instant_and_duplicates_collapse(spark):
    feed = couriers(
        spark,
        *ride(40.66, 41.2, 40.66),
        {"t": 60, "latitude": 41.3},
        {"t": 60, "latitude": 45.0, "is_duplicate": True},
    )
    assert [r.event_id for r in M.location_jumps(feed).collect()] == ["e00001"]


def test_label_score(spark):
    points = ride(40.66, 41.2, 40.66, 40.66)
    points[1]["anomaly_flag"] = "LOCATION_JUMP"
    points[3]["anomaly_flag"] = "LOCATION_JUMP"
    points[2]["anomaly_flag"] = "IMPOSSIBLE_SPEED"
    jump, speed = M.anomaly_label_score(couriers(spark, *points)).collect()
    assert (jump.labelled, jump.detected, jump.precision, jump.recall) == (2, 1, 1.0, 0.5)
    assert (speed.labelled, speed.detected, speed.recall) == (1, None, None)


def test_zones_of_pings(spark):
    feed = couriers(spark, {}, {"latitude": 40.61}, {"latitude": 10.0})
    found = {r.located_zone: r.pings for r in M.zones_of_pings(feed).collect()}
    assert found == {"zone_west": 1, "zone_suburbs": 1, None: 1}
