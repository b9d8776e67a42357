"""Late data, restart, flush, concurrent queries and stateful operators on streams."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from frames import couriers, orders

from dispatchlens import schemas
from dispatchlens.operators.orders import order_volume
from dispatchlens.plans.catalog import ANALYTICS
from dispatchlens.operators import lifecycle, quality
from dispatchlens.session import CHECKPOINT_CONF, new_run_folder, shared_folder, streaming_session
from dispatchlens.sources.files import read_feed, read_results
from dispatchlens.streaming import runner, stateful
from dispatchlens.streaming.replay import FLUSH_ID, Replay
from oracle import feeds as fixture

DAY = 86_400
ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def session(spark):
    return streaming_session(spark, rocksdb=False)


class Folder:
    """A feed folder that grows file by file, and the sink next to it."""

    def __init__(self, session, schema):
        self.session, self.schema = session, schema
        self.base = new_run_folder(session, "stream")

    def add(self, frame):
        frame.coalesce(1).write.mode("append").parquet(f"{self.base}/feed")

    def stream(self):
        return read_feed(
            self.session, f"{self.base}/feed", self.schema, True, maxFilesPerTrigger="1"
        )

    def run(self, results, name="uc1_order_volume", partition_by=("window_date",)):
        query = runner.parquet_sink(
            results, name, f"{self.base}/out", f"{self.base}/ck", partition_by, available_now=True
        )
        runner.finish_all([query])
        schema = schemas.as_nullable(results.schema)
        return self.session.read.schema(schema).parquet(f"{self.base}/out/{name}")


def minutes(frame):
    rows = frame.orderBy("window_start").collect()
    return {int((r.window_start.timestamp() - 1704110400) // 60): r.total_orders for r in rows}


def test_rows_behind_the_watermark_do_not_change_closed_windows(session):
    folder = Folder(session, schemas.ORDER_FEED)
    folder.add(orders(session, {"t": 10}, {"t": 20}))
    folder.add(orders(session, {"t": 300}))
    # the window closes in the batch after the one that moved the watermark
    folder.add(orders(session, {"t": 301}))
    folder.add(orders(session, {"t": 30}, {"t": 302}))
    folder.add(orders(session, {"t": DAY}))
    assert minutes(folder.run(order_volume(folder.stream()))) == {0: 2, 5: 3}


def test_a_late_row_inside_the_watermark_still_counts(session):
    folder = Folder(session, schemas.ORDER_FEED)
    folder.add(orders(session, {"t": 10}))
    folder.add(orders(session, {"t": 85}))
    folder.add(orders(session, {"t": 40}))
    folder.add(orders(session, {"t": DAY}))
    assert minutes(folder.run(order_volume(folder.stream()))) == {0: 2, 1: 1}


def test_filtered_rows_do_not_move_the_watermark(session):
    folder = Folder(session, schemas.ORDER_FEED)
    folder.add(orders(session, {"t": 10}))
    folder.add(orders(session, {"t": DAY, "is_duplicate": True}))
    folder.add(orders(session, {"t": 20}))
    assert minutes(folder.run(order_volume(folder.stream()))) == {}


def test_restart_goes_on_without_repeating(session):
    folder = Folder(session, schemas.ORDER_FEED)
    folder.add(orders(session, {"t": 10}))
    folder.add(orders(session, {"t": 300}))
    assert minutes(folder.run(order_volume(folder.stream()))) == {0: 1}
    folder.add(orders(session, {"t": 310}))
    folder.add(orders(session, {"t": DAY}))
    stored = folder.run(order_volume(folder.stream()))
    assert minutes(stored) == {0: 1, 5: 2}
    assert stored.count() == 2


@pytest.fixture(scope="module")
def stored(spark, tables):
    base = new_run_folder(spark, "stored")
    for name, feed in fixture.feeds(spark, tables).items():
        feed.write.parquet(f"{base}/{name}")
    return base


def streams(session, stored, *names):
    schema = {"orders": schemas.ORDER_FEED, "couriers": schemas.COURIER_FEED}
    return {n: read_feed(session, f"{stored}/{n}", schema[n], True) for n in names}


def test_all_nine_run_side_by_side(session, spark, tables, stored):
    feeds = streams(session, stored, "orders", "couriers")
    base = new_run_folder(spark, "all")
    queries = runner.start_all(feeds, f"{base}/out", f"{base}/ck", available_now=True)
    assert sorted(q.name for q in queries) == sorted(ANALYTICS)
    runner.finish_all(queries)
    assert all(not q.isActive for q in queries)
    found = read_results(spark, f"{base}/out", "uc1_order_volume")
    assert found.count() > 0
    # without flush rows the last windows stay open
    feed = {"orders": fixture.order_feed(spark, tables)}
    assert found.count() < ANALYTICS["uc1_order_volume"](feed).count()


def test_failed_start_stops_the_others(session, stored):
    base = new_run_folder(session, "broken")
    with pytest.raises(KeyError):
        runner.start_all(
            streams(session, stored, "orders"), base, f"{base}/ck", ["uc1_order_volume", "uc7_anomalies"]
        )
    assert not session.streams.active


def test_dedup_across_batches(session):
    folder = Folder(session, schemas.ORDER_FEED)
    folder.add(orders(session, {"event_id": "x"}, {"event_id": "x"}, {"event_id": "y"}))
    # copies come up to 300 seconds late
    folder.add(orders(session, {"event_id": "z", "t": 300}))
    folder.add(orders(session, {"event_id": "x"}, {"event_id": "late"}))
    folder.add(orders(session, {"event_id": "flush", "t": DAY}))
    rows = folder.stream().select("event_id", "order_status", "event_timestamp")
    kept = folder.run(stateful.dedup_stream(rows), "dedup", ())
    assert sorted(r.event_id for r in kept.collect()) == ["late", "x", "y", "z"]


def test_sessions_split_at_the_gap(session):
    folder = Folder(session, schemas.COURIER_FEED)
    folder.add(couriers(session, *[{"t": t} for t in (0, 200, 450, 800, 900)]))
    folder.add(couriers(session, {"t": DAY, "courier_id": "flush"}))
    found = folder.run(stateful.activity_sessions(folder.stream()), "sessions", ())
    rows = found.orderBy("session_start").collect()
    assert [r.pings for r in rows] == [3, 2]
    assert (rows[0].session_end - rows[0].session_start).seconds == 750


def test_promise_join_is_bounded_and_never_multiplies(session):
    placed = {"estimated_delivery_time_seconds": 1000}
    done = {"order_status": "DELIVERED", "actual_delivery_time_seconds": 1200}
    folder = Folder(session, schemas.ORDER_FEED)
    folder.add(
        orders(
            session,
            {"order_id": "a", **placed},
            {"order_id": "a", **placed, "event_id": "again"},
            {"order_id": "a", "t": 1200, **done},
            {"order_id": "a", "t": 1200, **done, "event_id": "done again"},
            {"order_id": "a", "t": 2000, **done, "customer_rating": 4.0},
            {"order_id": "too late", **placed},
            {"order_id": "too late", "t": 7 * 3600, **done},
        )
    )
    flush = {"order_id": "flush", "t": 3 * DAY}
    folder.add(orders(session, {**flush, **placed}, {**flush, **done}))
    errors = stateful.promise_errors_stream(folder.stream(), folder.stream())
    rows = folder.run(errors, "promises", ()).collect()
    assert sorted((r.order_id, r.error_seconds) for r in rows) == [("a", 200), ("too late", None)]
    # the batch form gives the same orders
    schema = schemas.as_nullable(schemas.ORDER_FEED)
    whole = lifecycle.promise_errors(session.read.schema(schema).parquet(f"{folder.base}/feed"))
    whole = whole.where("order_id <> 'flush'").collect()
    assert sorted((r.order_id, r.error_seconds) for r in whole) == [("a", 200), ("too late", None)]


@pytest.mark.parametrize("rocksdb", [True, False])
def test_replay_equals_batch_with_either_state_store(spark, tables, rocksdb):
    name = "uc9_supply_demand"
    feeds = fixture.feeds(spark, tables)
    batch = ANALYTICS[name](feeds)
    replay = Replay(spark, feeds, rocksdb=rocksdb)
    stream = replay.analytic(name)
    assert stream.columns == batch.columns
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0
    assert replay.data_batches() >= 4 and replay.dropped_rows() == 0


@pytest.mark.parametrize("name", ["uc1_order_volume", "uc13_courier_productivity"])
def test_ordered_feeds_lose_nothing_over_many_batches(spark, tables, name):
    feeds = fixture.feeds(spark, tables)
    replay = Replay(spark, feeds, slices=6)
    stream, batch = replay.analytic(name), ANALYTICS[name](feeds)
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0
    assert replay.data_batches() >= 7 and replay.dropped_rows() == 0


def test_disorder_beyond_the_watermark_loses_the_late_rows(spark, session):
    """Events arrive by ingestion time; those whose lag is over 30 seconds are the late ones."""
    rows = [{"t": 60 * i, "lag_ms": 100, "event_id": f"a{i}"} for i in range(30)]
    rows += [{"t": 60 * i + 5, "lag_ms": 400_000, "event_id": f"b{i}"} for i in (3, 7, 11)]
    feed = orders(session, *rows)
    replay = Replay(spark, {"orders": feed}, slices=len(rows), order_by="ingestion_timestamp")
    found = replay.analytic("uc1_order_volume")
    late = quality.late_arrivals(feed, couriers(session)).where("feed = 'orders'").first().late_by_lag
    assert late == 3
    assert found.agg({"total_orders": "sum"}).first()[0] == len(rows) - late
    assert replay.dropped_rows() == late
    assert replay.run(replay.orders().select("event_id"), "ids").where(f"event_id = '{FLUSH_ID}'").count() == 3


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get(CHECKPOINT_CONF)
    assert new_run_folder(spark, "a") != new_run_folder(spark, "a")


def test_shared_folder_without_a_checkpoint_folder(spark):
    """No setting is written: the warehouse takes the data, or the folder of the own setting."""

    class Session:
        def __init__(self, **confs):
            self.confs = {"spark.sql.warehouse.dir": "file:/w", **confs}
            self.conf = self

        def get(self, key, default=None):
            return self.confs.get(key, default)

    assert shared_folder(Session()) == "file:/w/dispatchlens-scratch"
    assert shared_folder(Session(**{"spark.dispatchlens.scratch": "s3a://b/x/"})) == "s3a://b/x"
    assert shared_folder(Session(**{CHECKPOINT_CONF: "hdfs:/ck"})) == "hdfs:/ck"


def test_queries_run_in_a_session_without_a_checkpoint_folder(tables, tmp_path):
    """In a process of its own, as the setting belongs to the application."""
    script = tmp_path / "run.py"
    script.write_text(
        f"""
import sys
sys.path[:0] = {[str(ROOT)]!r}
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2")
    .config("spark.sql.warehouse.dir", {str(tmp_path / "warehouse")!r}).getOrCreate()
)
assert spark.conf.get("spark.checkpoint.dir", None) is None
zone = spark.conf.get("spark.sql.session.timeZone")
for name in ("io_jsonl_roundtrip", "io_results_roundtrip", "stream_uc7"):
    assert entry.queries()[name](spark, {str(tables)!r}).count() > 0
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert spark.conf.get("spark.sql.session.timeZone") == zone
print("ran")
"""
    )
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK")}
    env |= {"SPARK_CONF_DIR": str(tmp_path), "TZ": "America/New_York", "PYTHONPATH": str(ROOT)}
    done = subprocess.run(
        [sys.executable, str(script)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert done.stdout.strip().endswith("ran"), done.stderr[-2000:]


def test_streaming_width_is_the_callers(spark):
    for width in ("4", "200", "7"):
        session = spark.newSession()
        session.conf.set("spark.sql.shuffle.partitions", width)
        assert streaming_session(session).conf.get("spark.sql.shuffle.partitions") == width


def test_a_batch_writes_one_file_per_date(session):
    """Not one per date and shuffle partition."""
    folder = Folder(session, schemas.ORDER_FEED)
    folder.add(orders(session, *({"t": 60 * i + DAY * d} for i in range(40) for d in range(3))))
    folder.add(orders(session, {"t": 9 * DAY}))
    stored = folder.run(order_volume(folder.stream()))
    files = [f for f in stored.inputFiles() if "window_date=" in f]
    # the last window closes a batch after the others of its date
    assert stored.count() == 120 and len(files) == 4


def test_slices_of_few_rows_stay_apart(spark):
    """A slice of fewer rows than files is filled up, so that no batch reads into the next slice."""
    rows = [{"t": 0}, *({"t": 1_000 + i} for i in range(50)), {"t": 5_000}]
    cuts = [1_704_110_400_000_000 + s * 1_000_000 for s in (500, 3_000)]
    replay = Replay(spark, {"orders": orders(spark, *rows)}, files=4, cuts=cuts)
    replay.run(replay.orders().select("event_id"), "ids")
    assert [p["numInputRows"] for p in replay.progress if p["numInputRows"]] == [1, 50, 1, 3]
