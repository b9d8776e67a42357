"""Schemas, derived feeds, files and the optional connectors."""

import json

import pytest
from frames import orders, result

from dispatchlens import dimensions as dim
from dispatchlens import schemas
from dispatchlens.session import new_run_folder
from dispatchlens.sources import files, kafka
from oracle import feeds as fixture


def test_feed_schemas():
    assert len(schemas.ORDER_FEED) == 24 and len(schemas.COURIER_FEED) == 23
    assert schemas.enum_columns(schemas.COURIER_FEED)["anomaly_flag"] == list(dim.ANOMALY_FLAGS)


def test_avro_layout():
    record = json.loads(schemas.avro_schema(schemas.ORDER_FEED))
    fields = {f["name"]: f for f in record["fields"]}
    assert list(fields) == schemas.ORDER_FEED.fieldNames()
    assert fields["event_timestamp"]["type"] == {"type": "long", "logicalType": "timestamp-millis"}
    assert fields["order_total_cents"]["type"] == ["null", "int"]
    assert fields["order_status"]["type"]["symbols"] == list(dim.ORDER_STATUSES)
    assert fields["previous_status"]["type"][1]["type"] == "enum"
    assert fields["order_items"]["type"][1]["items"]["fields"][2] == {"name": "quantity", "type": "int"}
    assert fields["metadata"]["type"] == ["null", {"type": "map", "values": "string"}]
    names = []

    def collect(node):
        if isinstance(node, dict):
            if node.get("type") in ("enum", "record"):
                names.append(node["name"])
            for child in node.values():
                collect(child)
        elif isinstance(node, list):
            for child in node:
                collect(child)

    collect(record)
    assert len(names) == len(set(names)), "Avro names must be unique"


def test_derived_feeds_follow_the_contract(spark, tables):
    for feed, schema in (
        (fixture.order_feed(spark, tables), schemas.ORDER_FEED),
        (fixture.courier_feed(spark, tables), schemas.COURIER_FEED),
    ):
        assert feed.columns == schema.fieldNames()
        types = dict(feed.dtypes)
        assert types == {f.name: f.dataType.simpleString() for f in schema}
        required = [f.name for f in schema if not f.nullable]
        assert feed.dropna("any", subset=required).count() == feed.count()


def test_event_ids_repeat_only_on_duplicates(spark, tables):
    feed = fixture.order_feed(spark, tables)
    originals = feed.filter("NOT is_duplicate")
    assert originals.select("event_id").distinct().count() == originals.count()


def test_totals_are_those_of_the_items(spark, tables):
    placed = fixture.order_feed(spark, tables).where("order_status = 'PLACED' AND NOT is_duplicate")
    sums = placed.selectExpr(
        "order_total_cents - aggregate(order_items, 0L, (s, x) -> s + x.quantity * x.unit_price_cents)"
        " AS off"
    )
    assert {r.off for r in sums.distinct().collect()} == {0, 1, None}


def test_avro_has_no_values_outside_enums(spark):
    feed = orders(spark, {"cancellation_reason": "NO_REASON"}, {"cancellation_reason": "SYSTEM_ERROR"})
    path = new_run_folder(spark, "avro")
    files.write_avro(feed, path, schemas.ORDER_FEED)
    back = files.read_avro(spark, path, schemas.ORDER_FEED)
    assert sorted(str(r.cancellation_reason) for r in back.collect()) == ["None", "SYSTEM_ERROR"]


def test_topic_options_bound_a_batch():
    assert "maxOffsetsPerTrigger" not in kafka.topic_options("t", {})
    assert kafka.topic_options("t", {}, "earliest", 500)["maxOffsetsPerTrigger"] == "500"


def test_publishing_a_stream(spark):
    base = new_run_folder(spark, "publish")
    path = f"{base}/feed"
    orders(spark, {"zone_id": "zone_east"}, {"zone_id": "zone_west"}).coalesce(1).write.parquet(path)
    feed = files.read_feed(spark, path, schemas.ORDER_FEED, True)
    records = feed.selectExpr("cast(zone_id AS binary) AS key", "cast(event_id AS binary) AS value")
    for more in (0, 1):
        # the second run finds only what came since
        if more:
            orders(spark, {"zone_id": "zone_uptown"}).coalesce(1).write.mode("append").parquet(path)
        query = kafka.publish_stream(
            records, "topic", {"path": f"{base}/topic"}, f"{base}/ck", sink="parquet"
        )
        query.awaitTermination()
    sent = spark.read.parquet(f"{base}/topic")
    assert sorted(bytes(r.key).decode() for r in sent.collect()) == ["zone_east", "zone_uptown", "zone_west"]


def test_json_lines_keep_every_column(spark):
    item = {"item_id": "i", "item_name": "n", "quantity": 2, "unit_price_cents": 3}
    feed = orders(
        spark,
        {"order_items": [item], "metadata": {"k": "v"}, "customer_rating": 4.5, "lag_ms": 123},
        {"order_total_cents": 5},
    )
    path = new_run_folder(spark, "jsonl")
    files.write_json_lines(feed, path, schemas.ORDER_FEED)
    line = json.loads(spark.read.text(path).filter("value LIKE '%e00000%'").first()[0])
    assert line["event_timestamp"] == 1704110400000
    assert line["order_total_cents"] is None
    back = files.read_json_lines(spark, path, schemas.ORDER_FEED)
    assert sorted(map(str, back.collect())) == sorted(map(str, feed.collect()))


def test_avro_files_keep_every_column(spark):
    item = {"item_id": "i", "item_name": "n", "quantity": 2, "unit_price_cents": 3}
    feed = orders(
        spark,
        {"order_items": [item], "metadata": {"k": "v"}, "customer_rating": 4.5, "lag_ms": 123},
        {"order_total_cents": 5, "previous_status": "PLACED", "cancellation_reason": "SYSTEM_ERROR"},
    )
    path = new_run_folder(spark, "avro")
    files.write_avro(feed, path, schemas.ORDER_FEED)
    back = files.read_avro(spark, path, schemas.ORDER_FEED)
    assert back.columns == feed.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, feed.collect()))


def test_avro_refuses_values_outside_an_enum(spark):
    feed = orders(spark, {"order_status": "LOST"})
    with pytest.raises(Exception, match="LOST"):
        files.write_avro(feed, new_run_folder(spark, "avro"), schemas.ORDER_FEED)


def test_results_append_and_prune(spark):
    base, name = new_run_folder(spark, "results"), "uc1_order_volume"
    assert files.read_results(spark, base, name).count() == 0
    row = {"zone_id": "a", "total_orders": 1, "cancelled_orders": 0, "cancellation_rate": 0.0}
    files.write_results(result(spark, name, row, {**row, "m": 24 * 60}), base, name)
    files.write_results(result(spark, name, {**row, "m": 48 * 60}), base + "/", name)
    stored = files.read_results(spark, base, name)
    assert stored.columns == schemas.result_schema(name).fieldNames()
    assert stored.count() == 3
    bounded = files.read_results(spark, base, name, "2024-01-02", "2024-01-02")
    assert bounded.count() == 1
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan


def test_unreadable_results_are_not_hidden(spark):
    base, name = new_run_folder(spark, "results"), "uc1_order_volume"
    spark.createDataFrame([("broken",)], "value string").write.text(
        f"{base}/{name}/window_date=2024-01-01"
    )
    spark.range(1).selectExpr("cast(id AS string) AS value").write.mode("append").text(
        f"{base}/{name}/window_date=2024-01-01"
    )
    with pytest.raises(Exception):
        files.read_results(spark, base, name).collect()


def test_topic_options():
    connection = kafka.sasl_connection("broker:9093", "user", "secret")
    options = kafka.topic_options("orders", connection, "earliest")
    assert options["subscribe"] == "orders" and options["startingOffsets"] == "earliest"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="user"' in options["kafka.sasl.jaas.config"]
    assert kafka.topic_options("t", {})["startingOffsets"] == "latest"


def test_avro_records_roundtrip(spark):
    if not kafka.connectors(spark)["avro"]:
        pytest.skip("spark-avro is not on the class path")
    feed = orders(spark, {"order_total_cents": 5}, {"cancellation_reason": "PAYMENT_FAILED"})
    back = kafka.decode_orders(kafka.to_records(feed, schemas.ORDER_FEED))
    assert len(back.columns) == 21
    assert sorted(r.event_id for r in back.collect()) == ["e00000", "e00001"]


def test_kafka_source_is_reported_missing(spark):
    if kafka.connectors(spark)["kafka"]:
        pytest.skip("the Kafka connector is on the class path")
    with pytest.raises(Exception, match="kafka"):
        kafka.read_topic(spark, {"subscribe": "orders"})


def test_json_lines_are_compressed(spark):
    """Every line repeats the names of all columns."""
    feed, path = orders(spark, *({"t": i} for i in range(2_000))), new_run_folder(spark, "jsonl")
    files.write_json_lines(feed, path, schemas.ORDER_FEED)
    stored = spark.read.format("binaryFile").load(path).selectExpr("sum(length)").first()[0]
    read = files.read_json_lines(spark, path, schemas.ORDER_FEED)
    assert stored < 2_000 * 100 and sorted(read.collect()) == sorted(feed.collect())
