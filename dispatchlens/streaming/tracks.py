"""Neighbours of track points on a stream, by state with event-time timers.

Couriers are dealt to buckets.  A bucket's state are points: of each track those that still wait for their
next point, and the two before them.  All points of a bucket that came in a batch are handled at once as
columns, however many couriers they are of; no function is called per row.  The state holds them as columns
too, some ten thousand in a value: Spark hands over each value of a state by itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.windows import LATENESS
from ..operators.motion import TRACK, jumps, judge
from ..operators.orders import originals

#: a track without a point for so long is over: its last point is told without a next one
TRACK_TIMEOUT_MS = 3_600_000
_POINT = ["at", "lat", "lon"]
_HELD = pa.schema(
    [(name, pa.string()) for name in ("courier_id", "session_id", "event_id", "vehicle_type")]
    + [("at", pa.int64()), ("lat", pa.float64()), ("lon", pa.float64()), ("told", pa.bool_())]
)
_COLUMNS = _HELD.names
#: points in a value of the state, a few megabytes
_AT_ONCE = 1 << 15
_AROUND = {"previous": 1, "next": -1, "earlier": 2}
_TOLD = (
    "courier_id string, session_id string, event_id string, vehicle_type string, "
    "at bigint, lat double, lon double"
) + "".join(
    f", {name}_at bigint, {name}_lat double, {name}_lon double" for name in _AROUND
)


def packed(points: pd.DataFrame) -> list[tuple[bytes]]:
    """Points as values of a state."""
    table, values = pa.Table.from_pandas(points[_COLUMNS], _HELD, preserve_index=False), []
    for start in range(0, len(points), _AT_ONCE):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _HELD) as stream:
            stream.write_table(table.slice(start, _AT_ONCE))
        values.append((sink.getvalue().to_pybytes(),))
    return values


def unpacked(values: Iterable[tuple[bytes]]) -> pd.DataFrame:
    """The points of a state's values."""
    return pa.concat_tables(pa.ipc.open_stream(bytes(value)).read_all() for (value,) in values).to_pandas()


class Neighbours(StatefulProcessor):
    """Tells each point, once, when the watermark has passed the point after it or the track is over."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.points = handle.getListState("points", "points binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [frame.assign(told=False)[_COLUMNS] for frame in rows]
        yield self._settle(frames, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._settle([], timerValues.getCurrentWatermarkInMs())

    def _settle(self, frames: list[pd.DataFrame], watermark: int) -> pd.DataFrame:
        if self.points.exists():
            frames = [unpacked(self.points.get()), *frames]
        if not frames:
            return told_points(pd.DataFrame(columns=_COLUMNS), pd.Series(dtype=bool))
        points, ready, kept, due = settle(pd.concat(frames, ignore_index=True), watermark, self.timeout_ms)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(kept):
            self.points.put(packed(kept))
            self.handle.registerTimer(due)
        else:
            self.points.clear()
        return told_points(points, ready)


def settle(points: pd.DataFrame, watermark: int, timeout_ms: int):
    """Points in order with those around them; which are told now; those to keep; the time of the next
    change.

    Pings of one track and millisecond are one point, that of the least event id.
    """
    points = points.sort_values([*TRACK, "at", "event_id"]).drop_duplicates([*TRACK, "at"])
    points = points.reset_index(drop=True)
    track = points.groupby(TRACK, sort=False, dropna=False)
    for name, step in _AROUND.items():
        for column in _POINT:
            points[f"{name}_{column}"] = track[column].shift(step)
    last = points["next_at"].isna()
    settles = points["next_at"].where(~last, points["at"] + timeout_ms)
    told = points["told"].astype(bool)
    ready = ~told & (settles <= watermark)
    waits = ~told & ~ready
    # of each track what waits, and two points before the first that does
    before = waits.groupby([points[c] for c in TRACK], sort=False, dropna=False)
    near = waits | before.shift(-1, fill_value=False) | before.shift(-2, fill_value=False)
    kept = points[near].assign(told=(told | ready)[near])
    due = int(settles[waits].min()) + 1 if waits.any() else 0
    return points, ready, kept, due


def told_points(points: pd.DataFrame, ready: pd.Series) -> pd.DataFrame:
    """The points that are told, with whole numbers for times that may be missing."""
    out = points[ready] if len(points) else points.copy()
    for name in _AROUND:
        for column in _POINT:
            if f"{name}_{column}" not in out:
                out[f"{name}_{column}"] = pd.Series(dtype="float64")
    times = {f"{name}_at": "Int64" for name in _AROUND}
    columns = [c for c in _COLUMNS if c != "told"] + [f"{n}_{c}" for n in _AROUND for c in _POINT]
    return out[columns].astype({"at": "int64", **times})


def points_with_neighbours(
    couriers: DataFrame,
    buckets: int = 64,
    timeout_ms: int = TRACK_TIMEOUT_MS,
    lateness: str = LATENESS,
) -> DataFrame:
    """A stream of track points with the points around them, as ``with_neighbours`` gives on a table.

    ``buckets``: how many states there are; it is fixed for the life of a query.
    """
    pings = (
        originals(couriers)
        .filter("event_timestamp IS NOT NULL")
        .withWatermark("event_timestamp", lateness)
        .select(
            F.pmod(F.xxhash64("courier_id"), F.lit(buckets)).cast("int").alias("bucket"),
            *TRACK,
            "event_id",
            "vehicle_type",
            F.unix_millis("event_timestamp").alias("at"),
            F.col("latitude").alias("lat"),
            F.col("longitude").alias("lon"),
            "event_timestamp",
        )
    )
    told = pings.groupBy("bucket").transformWithStateInPandas(
        Neighbours(timeout_ms), outputStructType=_TOLD, outputMode="Append", timeMode="eventTime"
    )
    around = [
        F.when(
            F.col(f"{name}_at").isNotNull(), F.struct(*(F.col(f"{name}_{c}").alias(c) for c in _POINT))
        ).alias(name)
        for name in _AROUND
    ]
    return told.select(
        *TRACK, "at", "event_id", "vehicle_type", F.struct(*_POINT).alias("point"), *around
    )


def jumps_stream(couriers: DataFrame, **options) -> DataFrame:
    """Pings that left the courier's track at impossible speed, told as soon as the track goes on."""
    return jumps(judge(points_with_neighbours(couriers, **options)))
