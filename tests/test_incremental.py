"""Reports kept by a stream: batches that come again, snapshots, restart."""

from pathlib import Path

import pytest
from frames import couriers, orders

from dispatchlens.operators.orders import order_value, order_volume
from dispatchlens.plans import rollups
from dispatchlens.session import new_run_folder
from dispatchlens.streaming.incremental import PartialSums, merge_stream
from dispatchlens.streaming.replay import Replay
from dispatchlens.streaming.runner import finish_all


def values(spark, *rows):
    return spark.createDataFrame(
        [(z, n, e, r) for z, n, e, r in rows],
        "zone_id string, order_count bigint, avg_order_eur double, total_revenue_eur double",
    )


def test_a_batch_that_comes_again_changes_nothing(spark):
    sums = PartialSums(spark, new_run_folder(spark, "sums"), rollups.revenue_parts, ("zone_id",), fold_every=3)
    with pytest.raises(ValueError):
        sums.read()
    batches = [
        values(spark, ("a", 2, 10.25, 20.5), ("b", 1, 5.0, 5.0)), values(spark), values(spark, ("a", 1, 0.01, 0.01)),
        values(spark, ("c", 3, 1.5, 4.5), (None, 1, 1.0, 1.0)), values(spark, ("b", 7, 2.0, 14.0)),
        values(spark, ("a", 1, 3.33, 3.33)),
    ]
    seen = None
    for number, batch in enumerate(batches):
        seen = batch if seen is None else seen.unionByName(batch)
        wanted = sorted(map(tuple, rollups.revenue_by_zone(seen).collect()))
        for again in (number, number, max(0, number - 1), 0):  # the last one, the one before, a settled one
            sums.merge(batches[again], again)
            assert sorted(map(tuple, rollups.revenue_from_parts(sums.read()).collect())) == wanted
    assert sums.settled() == 3
    # a report reads one snapshot and the two batches after it
    assert len(sums.read().inputFiles()) == 3


def test_what_a_crash_left_unfinished_is_not_read(spark):
    sums = PartialSums(spark, new_run_folder(spark, "sums"), rollups.order_parts, fold_every=100)
    volume = spark.createDataFrame([(3, 1)], "total_orders bigint, cancelled_orders bigint")
    sums.merge(volume, 0)
    sums.merge(volume, 1)
    part = Path(sums.path.removeprefix("file:")) / "batch-1"
    (part / "_SUCCESS").unlink()
    assert sums.read().first().total_orders == 3
    sums.merge(volume, 1)
    assert sums.read().first().total_orders == 6


def test_a_batch_is_replayed_after_its_commit_was_lost(spark):
    rows = [{"t": 40 * i, "order_status": ("PLACED", "PLACED", "CANCELLED")[i % 3]} for i in range(300)]
    feed = orders(spark, *rows)
    replay = Replay(spark, {"orders": feed, "couriers": couriers(spark)}, slices=5, rocksdb=False)
    sums = PartialSums(spark, f"{replay.folder}/sums", rollups.order_parts, fold_every=4)
    merged = []

    def merge(batch_rows, batch):
        merged.append(batch)
        sums.merge(batch_rows, batch)

    replay.merge(order_volume(replay.orders()), merge, "volume")
    wanted = rollups.order_kpis(order_volume(feed)).collect()
    assert rollups.order_kpis(sums.read()).collect() == wanted
    commits = Path(replay.folder.removeprefix("file:")) / "checkpoints/volume/commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    query = merge_stream(order_volume(replay.orders()), merge, "volume", f"{replay.folder}/checkpoints", True)
    finish_all([query])
    assert merged.count(last) == 2
    assert rollups.order_kpis(sums.read()).collect() == wanted


def test_reports_of_a_stream_equal_those_of_the_table(spark):
    rows = [
        {"t": 40 * i, "order_total_cents": 100 + 37 * i, "zone_id": f"zone_{i % 3}", "event_id": f"e{i}"}
        for i in range(200)
    ]
    feed = orders(spark, *rows)
    replay = Replay(spark, {"orders": feed, "couriers": couriers(spark)}, slices=3, rocksdb=False)
    sums = PartialSums(spark, f"{replay.folder}/sums", rollups.revenue_parts, ("zone_id",), fold_every=2)
    replay.merge(order_value(replay.orders()), sums.merge, "value")
    found = rollups.revenue_from_parts(sums.read())
    assert sorted(map(tuple, found.collect())) == sorted(
        map(tuple, rollups.revenue_by_zone(order_value(feed)).collect())
    )
    assert sums.settled() >= 1
