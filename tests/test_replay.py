"""Replayed feeds: written once, by one pass, in slices that arrive in their order."""

import __spark_entry__ as entry
import pytest
from frames import couriers, orders
from pyspark.sql import functions as F

from dispatchlens.streaming import stateful
from dispatchlens.streaming.replay import FLUSH_ID, Replay

_ORDERED = "spark.sql.maxConcurrentOutputFileWriters"


def files(spark, folder):
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return found.load(folder).select("path", F.unix_millis("modificationTime").alias("at")).collect()


def test_a_feed_is_stored_once_in_slices_by_time(spark):
    rows = [{"event_id": f"e{i}", "t": 7 * (i * 37 % 400)} for i in range(400)]
    feed = orders(spark, *rows).repartition(6)
    replay = Replay(spark, {"orders": feed}, slices=4, files=3)
    before = spark.conf.get(_ORDERED, None)
    replay.orders()
    assert spark.conf.get(_ORDERED, None) == before
    found = files(spark, replay.folder)
    assert len(found) == 12 and all("/orders/" in f.path for f in found)
    stored = spark.read.schema(feed.schema).parquet(f"{replay.folder}/orders")
    assert sorted(map(str, stored.collect())) == sorted(map(str, feed.collect()))
    # files of a slice have one time, and all events of a slice come before those of the next
    times = sorted({f.at for f in found})
    assert [sum(f.at == t for f in found) for t in times] == [3, 3, 3, 3]
    told = stored.select(F.regexp_extract(F.input_file_name(), "/([0-9]+)-part", 1).alias("slice"), "event_timestamp")
    spans = sorted(map(tuple, told.groupBy("slice").agg(F.min("event_timestamp"), F.max("event_timestamp")).collect()))
    assert [s[0] for s in spans] == ["0", "1", "2", "3"]
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_batches_follow_the_slices_though_one_pass_writes_them(spark):
    rows = [{"event_id": f"e{i}", "t": 7 * (i * 37 % 400)} for i in range(400)]
    replay = Replay(spark, {"orders": orders(spark, *rows), "couriers": couriers(spark)}, slices=4, files=2)
    events = replay.orders().select("event_id", "order_id", "order_status", "event_timestamp")
    found = replay.run(stateful.dedup_stream(events), "dedup").filter(F.col("event_id") != FLUSH_ID)
    assert found.count() == 400 and replay.data_batches() == 5 and replay.dropped_rows() == 0


def test_shuffled_rows_of_a_batch_are_not_kept(spark):
    replay = Replay(spark, {"orders": orders(spark, {"t": 0})}, state_totals=False)
    assert replay.session.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    assert replay.session.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_the_audit_stores_each_feed_once(spark, tmp_path, monkeypatch):
    spark.range(1, 400).selectExpr("id o_orderkey", "id o_custkey", "'3-MEDIUM' o_orderpriority").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    spark.range(1, 400).selectExpr("id event_id", "id % 20 user_id", "'view' event_type").write.parquet(
        f"{tmp_path}/events.parquet"
    )
    written, write = [], Replay._write
    monkeypatch.setattr(Replay, "_write", lambda self, name: (written.append(name), write(self, name)))
    found = entry.queries()["stream_state_audit"](spark, str(tmp_path)).collect()
    assert sorted(written) == ["couriers", "orders"]
    assert {r["query"] for r in found} == {"uc9_supply_demand", "uc13_courier_productivity", "x_eta_accuracy"}


@pytest.mark.parametrize("always", [False, True])
def test_dealing_out_tables_keeps_all_rows(spark, tmp_path, always):
    spark.range(1, 300, numPartitions=40).selectExpr("id o_orderkey", "id o_custkey", "'3-MEDIUM' o_orderpriority").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    spark.range(1).selectExpr("id event_id", "id user_id", "'view' event_type").write.parquet(f"{tmp_path}/events.parquet")
    found = entry.fixture.feeds(spark, str(tmp_path), always)["orders"]
    assert sorted(map(str, found.collect())) == sorted(map(str, entry.fixture.order_feed(spark, str(tmp_path)).collect()))
    if always:
        assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
