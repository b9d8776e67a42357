"""Points in tables of boxes against brute force, and the plan of the join."""

import random

import pytest
from frames import couriers
from pyspark.sql import functions as F

from dispatchlens.functions.boxes import box_of_points
from dispatchlens.functions.domain import zone_at
from dispatchlens.operators import motion as M
from test_plans import no_broadcast, plan  # noqa: F401

BOXES = "box_id string, lat_lo double, lat_hi double, lon_lo double, lon_hi double, rank int"


def brute(points, boxes):
    found = {}
    for i, lat, lon in points:
        inside = [
            (rank, box) for box, a, b, c, d, rank in boxes
            if lat is not None and lon is not None and a <= lat < b and c <= lon < d
        ]
        found[i] = min(inside)[1] if inside else None
    return found


def located(spark, points, boxes, **options):
    frame = spark.createDataFrame(points, "id int, lat double, lon double")
    found = box_of_points(frame, spark.createDataFrame(boxes, BOXES), **options)
    rows = found.collect()
    assert len(rows) == len(points)
    return {r.id: r.box_id for r in rows}


def test_boxes_of_all_sizes(spark):
    rng = random.Random(7)
    boxes = [("world", -90.0, 90.0, -180.0, 180.0, 999), ("flat", 1.0, 1.0, 0.0, 5.0, 0), ("turned", 3.0, 2.0, 0.0, 5.0, 0)]
    for i in range(120):
        size = rng.choice([0.001, 0.03, 0.4, 3.0, 30.0])
        lat, lon = rng.uniform(-60, 60), rng.uniform(-150, 150)
        boxes.append((f"b{i}", lat, lat + size, lon, lon + size * rng.choice([0.2, 1, 4]), rng.randrange(50)))
    points = []
    for box in boxes[1:]:  # corners and edges: the lower ones belong to the box
        points += [(box[1], box[3]), (box[2], box[3]), (box[1], box[4]), ((box[1] + box[2]) / 2, box[3])]
    points += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    points += [(None, 1.0), (1.0, None), (0.0, 0.0), (-0.01, -0.01), (95.0, 10.0)]
    points = [(i, *p) for i, p in enumerate(points)]
    ties = {(b[5]): b for b in boxes}
    assert len(ties) < len(boxes)  # of equal ranks the lower id counts
    assert located(spark, points, boxes) == brute(points, boxes)
    assert located(spark, points, boxes, spread=1, levels=(5.0, 400.0)) == brute(points, boxes)
    assert set(located(spark, points, [], spread=2).values()) == {None}


def test_ten_thousand_zones_without_a_nested_loop(spark, no_broadcast):  # noqa: F811
    side = 100
    zones = [
        (f"z{i:03d}_{j:03d}", 40 + i / 50, 40 + (i + 1) / 50, -75 + j / 50, -75 + (j + 1) / 50, i * side + j)
        for i in range(side) for j in range(side)
    ]
    assert len(zones) == 10_000
    table = spark.createDataFrame(zones, BOXES).withColumnRenamed("box_id", "zone_id")
    rng = random.Random(1)
    # a third of all pings at one place
    places = [(40.101, -74.301)] * 700 + [(rng.uniform(39.9, 42.1), rng.uniform(-75.1, -72.9)) for _ in range(1_400)]
    feed = couriers(spark, *({"latitude": a, "longitude": b, "zone_id": "z"} for a, b in places))
    found = M.zones_of_pings(feed, table)
    text = plan(found)
    assert "NestedLoop" not in text and "Cartesian" not in text and "SortMergeJoin" in text
    wanted = brute([(i, *p) for i, p in enumerate(places)], zones)
    counts = {}
    for zone in wanted.values():
        counts[zone] = counts.get(zone, 0) + 1
    assert {r.located_zone: r.pings for r in found.collect()} == counts


@pytest.mark.parametrize("shift", [0.0, 1e-9])
def test_listed_zones_as_a_table(spark, shift):
    edges = [(lat + shift, lon) for lat in (40.6, 40.65, 40.7, 40.725, 40.755, 40.79) for lon in (-74.05, -74.0, -73.97, -73.95, -73.9)]
    feed = couriers(spark, *({"latitude": a, "longitude": b} for a, b in edges))
    found = {r.located_zone: r.pings for r in M.zones_of_pings(feed).collect()}
    plain = feed.groupBy(zone_at(F.col("latitude"), F.col("longitude")).alias("z")).count()
    assert found == {r.z: r["count"] for r in plain.collect()} and len(found) > 3
