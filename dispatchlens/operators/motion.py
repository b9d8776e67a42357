"""Courier positions: implied speed, jumps and zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dimensions import VEHICLE_MAX_KMH, ZONES
from ..functions.boxes import BOX, box_of_points
from ..functions.domain import haversine_km, lookup
from ..functions.neighbours import with_neighbours
from .orders import originals

TRACK = ["courier_id", "session_id"]


def _kmh(start: Column, end: Column) -> Column:
    """Speed implied by two track points; the points differ in time."""
    distance = haversine_km(start["lat"], start["lon"], end["lat"], end["lon"])
    return distance * 3.6e6 / (end["at"] - start["at"])


def track_points(couriers: DataFrame) -> DataFrame:
    """One point per courier, session and millisecond.

    Pings of the same instant collapse to the one with the least event id; the
    point is labelled a jump if any of them is.
    """
    fix = F.struct("event_id", "latitude", "longitude", "vehicle_type")
    at = F.unix_millis("event_timestamp").alias("at")
    flag = F.col("anomaly_flag")
    return (
        originals(couriers)
        .groupBy(*TRACK, at)
        .agg(
            F.min(fix).alias("fix"),
            F.count_if(flag == "LOCATION_JUMP").alias("jumps"),
            F.count_if(flag == "IMPOSSIBLE_SPEED").alias("speeds"),
        )
        .select(
            *TRACK,
            "at",
            F.col("fix.event_id").alias("event_id"),
            F.col("fix.vehicle_type").alias("vehicle_type"),
            F.struct("at", F.col("fix.latitude").alias("lat"), F.col("fix.longitude").alias("lon")).alias(
                "point"
            ),
            (F.col("jumps") > 0).alias("labelled_jump"),
            (F.col("speeds") > 0).alias("labelled_speed"),
        )
    )


def judged_points(couriers: DataFrame) -> DataFrame:
    """Track points with ``kmh`` from the previous point and the jump verdict.

    A point is a jump when it was reached faster than the vehicle can go, and
    the track goes on without it: the next point is within reach of the
    previous one.  The way back from a jump is as fast as the jump itself and
    must not count, which the last point of a track shows by being within reach
    of the point before the previous one.
    """
    offsets = {"previous": -1, "next": 1, "earlier": -2}
    return judge(with_neighbours(track_points(couriers), TRACK, "at", "point", offsets))


def judge(points: DataFrame) -> DataFrame:
    """Speed and verdict of points that come with the points around them."""
    here, previous, following, earlier = map(F.col, ("point", "previous", "next", "earlier"))
    limit = lookup(F.col("vehicle_type"), VEHICLE_MAX_KMH)
    returned = F.coalesce(_kmh(earlier, here) <= limit, F.lit(False))
    leaves_track = F.when(following.isNull(), ~returned).otherwise(
        _kmh(previous, following) <= limit
    )
    return points.withColumn("kmh", _kmh(previous, here)).withColumn(
        "detected", F.coalesce((F.col("kmh") > limit) & leaves_track, F.lit(False))
    )


def jumps(judged: DataFrame) -> DataFrame:
    """The points judged as jumps."""
    return judged.filter("detected").select(
        "event_id",
        *TRACK,
        "vehicle_type",
        F.timestamp_millis("at").alias("event_timestamp"),
        F.round("kmh", 3).alias("implied_kmh"),
    )


def location_jumps(couriers: DataFrame) -> DataFrame:
    """Pings that left the courier's track at impossible speed."""
    return jumps(judged_points(couriers))


def anomaly_label_score(couriers: DataFrame) -> DataFrame:
    """Precision and recall of jump detection against the feed's own labels.

    Impossible speed is reported by label only: such pings repeat the last
    position, so positions cannot reveal them.
    """
    found, label = F.col("detected"), F.col("labelled_jump")
    counts = judged_points(couriers).agg(
        F.count_if(label).alias("jumps"),
        F.count_if(found).alias("found"),
        F.count_if(found & label).alias("hits"),
        F.count_if("labelled_speed").alias("speeds"),
    )
    hits = F.col("hits")
    jump = F.struct(
        F.lit("LOCATION_JUMP").alias("anomaly_flag"),
        F.col("jumps").alias("labelled"),
        F.col("found").alias("detected"),
        hits.alias("true_positives"),
        F.round(F.when(F.col("found") > 0, hits / F.col("found")), 4).alias("precision"),
        F.round(F.when(F.col("jumps") > 0, hits / F.col("jumps")), 4).alias("recall"),
    )
    speed = F.struct(
        F.lit("IMPOSSIBLE_SPEED").alias("anomaly_flag"),
        F.col("speeds").alias("labelled"),
        F.lit(None).cast("bigint").alias("detected"),
        F.lit(None).cast("bigint").alias("true_positives"),
        F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
    )
    return counts.select(F.inline(F.array(jump, speed)))


def listed_zones(spark: SparkSession) -> DataFrame:
    """The listed zones as a table of boxes; of two that hold a point the first counts."""
    rows = [(*zone, rank) for rank, zone in enumerate(ZONES)]
    return spark.createDataFrame(rows, "zone_id string, " + ", ".join(f"{c} double" for c in BOX) + ", rank int")


def zones_of_pings(couriers: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Pings by the zone they state and the zone their position lies in.

    ``zones``: ``zone_id``, the edges of its box and its ``rank``, in any number; the listed ones if not
    given.  Pings of one place and
    stated zone are counted before they meet the boxes.
    """
    at = F.col("latitude").alias("lat"), F.col("longitude").alias("lon")
    places = couriers.groupBy(F.col("zone_id"), *at).agg(F.count("*").alias("n"))
    zones = listed_zones(couriers.sparkSession) if zones is None else zones
    boxes = zones.withColumnRenamed("zone_id", "located_zone")
    found = box_of_points(places, boxes, "located_zone")
    return found.groupBy("zone_id", "located_zone").agg(F.sum("n").alias("pings"))
