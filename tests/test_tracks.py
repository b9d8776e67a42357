"""Track neighbours on a stream against those of a table, and its state."""

import random

import pandas as pd
from frames import couriers

from dispatchlens.functions.neighbours import with_neighbours
from dispatchlens.operators.motion import TRACK, location_jumps, track_points
from dispatchlens.streaming import tracks
from dispatchlens.streaming.replay import FLUSH_ID, Replay

HOUR = 3_600_000


def frame(rows):
    columns = tracks._COLUMNS
    return pd.DataFrame([dict(zip(columns, row)) for row in rows], columns=columns)


def random_points(rng, tracks_, n, span):
    rows = []
    for i in range(n):
        c = f"c{rng.randrange(tracks_)}"
        rows.append((c, f"s{c}", f"e{i:05d}", "CAR", rng.randrange(span), float(i), -float(i), False))
    return rows


def test_points_in_many_batches_are_told_once_with_their_neighbours():
    rng = random.Random(6)
    for tracks_, span, timeout in ((1, 5_000, 10**9), (7, 20_000, 10**9), (7, 20_000, 700)):
        rows = sorted(random_points(rng, tracks_, 400, span), key=lambda r: r[4] + rng.randrange(300))
        held, told, most = frame([]), [], 0
        for at in range(0, len(rows) + 40, 40):
            batch = frame(rows[at : at + 40])
            # a point comes at most 300 ms behind another one
            seen = [r[4] for r in rows[:at]]
            watermark = (max(seen) - 300 if seen else 0) if at < len(rows) else 10**12
            points, ready, held, due = tracks.settle(pd.concat([held, batch], ignore_index=True), watermark, timeout)
            told += tracks.told_points(points, ready).to_dict("records")
            assert due > watermark or not len(held)
            most = max(most, len(held))
        assert not len(held) and most < 40 + 300 + 3 * tracks_
        least = {}
        for r in sorted(rows, key=lambda r: r[2]):
            least.setdefault((r[0], r[4]), r)
        assert len(told) == len(least)
        by_track = {}
        for (c, at), r in sorted(least.items()):
            by_track.setdefault(c, []).append(r)
        for got in told:
            own = by_track[got["courier_id"]]
            i = next(i for i, r in enumerate(own) if r[4] == got["at"])
            assert got["event_id"] == own[i][2]
            for name, j in (("previous", i - 1), ("next", i + 1), ("earlier", i - 2)):
                there = own[j] if 0 <= j < len(own) else None
                # after a pause as long as the timeout, a track is over and begins anew
                if timeout < 10**9:
                    continue
                value = got[f"{name}_at"]
                assert (None if pd.isna(value) else value) == (there and there[4]), (name, got)


def pings(spark, rng, n):
    rows = []
    for i in range(n):
        hot = rng.random() < 0.4
        c = "hot" if hot else f"c{rng.randrange(9)}"
        rows.append(
            {"courier_id": c, "session_id": f"s-{c}", "t": rng.randrange(3_000), "event_id": f"e{i:05d}",
             "latitude": 40.6 + rng.random() / 10, "longitude": -74.0 + rng.random() / 10,
             "vehicle_type": rng.choice(["CAR", "FOOT"]), "is_duplicate": rng.choice([False, False, True, None])}
        )
    return couriers(spark, *rows)


def test_stream_equals_table(spark):
    feed = pings(spark, random.Random(8), 600)
    replay = Replay(spark, {"couriers": feed}, slices=5)
    found = replay.run(tracks.points_with_neighbours(replay.couriers(), buckets=5), "points")
    offsets = {"previous": -1, "next": 1, "earlier": -2}
    wanted = with_neighbours(track_points(feed), TRACK, "at", "point", offsets)
    columns = [*TRACK, "at", "event_id", "point", "previous", "next", "earlier"]
    key = lambda r: (r.courier_id, r.at)
    kept = found.filter(found.courier_id != FLUSH_ID)
    assert sorted(kept.select(columns).collect(), key=key) == sorted(wanted.select(columns).collect(), key=key)
    assert replay.data_batches() >= 5 and replay.dropped_rows() == 0


def test_state_holds_open_ends_only(spark):
    rng = random.Random(9)
    feed = pings(spark, rng, 1_500)
    replay = Replay(spark, {"couriers": feed}, slices=6)
    stream = tracks.jumps_stream(replay.couriers(), buckets=4)
    found = {r.event_id for r in replay.run(stream, "jumps").collect()}
    assert found == {r.event_id for r in location_jumps(feed).collect()} and found
    batches = [p for p in replay.progress if p["numInputRows"]]
    assert len(batches) >= 6
    # ten tracks: three points of each at most, and those of the last 30 seconds of 3,000 (15 rows)
    rows = [s["numRowsTotal"] for p in replay.progress for s in p["stateOperators"]]
    assert max(rows) < 4 * 4 + 10 * 3 + 1_500 // 6


def test_a_track_ends_after_its_timeout(spark):
    # the way back is told as a jump only where the track goes on; here it does not
    far = {"courier_id": "a", "session_id": "s", "latitude": 41.9, "event_id": "far", "t": 60}
    feed = couriers(spark, {"courier_id": "a", "session_id": "s", "event_id": "first"}, far)
    replay = Replay(spark, {"couriers": feed}, slices=2)
    found = replay.run(tracks.jumps_stream(replay.couriers()), "jumps").collect()
    assert [r.event_id for r in found] == [r.event_id for r in location_jumps(feed).collect()] == ["far"]
    assert replay.progress[-1]["stateOperators"][0]["numRowsTotal"] <= 5  # the flush row's own state


def test_state_holds_many_points_in_a_value():
    rows = [("c", None, f"e{i}", "CAR", i, None if i % 3 else 1.5, float(i), i % 2 == 0) for i in range(100_000)]
    points = frame(rows)
    values = tracks.packed(points)
    assert 1 < len(values) < 10 and all(len(v) < 8 << 20 for (v,) in values)
    pd.testing.assert_frame_equal(tracks.unpacked(values), points)
    assert tracks.packed(points[:0]) == []
    assert tracks.unpacked(tracks.packed(frame([(None, None, "e", None, 5, None, None, True)]))).at[0, "at"] == 5
