"""Feeds on Kafka topics: key is the zone, value the Avro record.

Spark's Kafka and Avro connectors are optional packages.  ``connectors`` tells
which of them a session has; connection options always come from the caller.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import COURIER_FEED, ORDER_FEED, avro_columns, avro_schema
from .files import cast_to

# not part of the analytics: left out when a topic is decoded
_UNDECODED = {"schema_version", "order_items", "metadata"}


def connectors(spark: SparkSession) -> dict[str, bool]:
    """Which optional connectors the session can use; nothing is contacted."""
    from pyspark.sql.avro.functions import to_avro

    def usable(attempt) -> bool:
        try:
            attempt()
        except AnalysisException:
            return False
        except PySparkException:
            return True  # the connector is there and misses its options
        return True

    return {
        "kafka": usable(lambda: spark.readStream.format("kafka").load()),
        "avro": usable(lambda: spark.range(0).select(to_avro("id"))),
    }


def topic_options(
    topic: str,
    connection: Mapping[str, str],
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Reader options for one topic on top of the caller's connection options.

    ``max_offsets`` bounds a batch; without it the first one from ``earliest`` is the whole topic.
    """
    options = {
        **connection,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "groupIdPrefix": f"dispatchlens-{topic}",
    }
    return options | ({"maxOffsetsPerTrigger": str(max_offsets)} if max_offsets else {})


def sasl_connection(servers: str, username: str, password: str) -> dict[str, str]:
    """Connection options for a SASL_SSL/PLAIN endpoint."""
    login = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f'{login} required username="{username}" password="{password}";',
    }


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def _decode(records: DataFrame, schema: T.StructType) -> DataFrame:
    from pyspark.sql.avro.functions import from_avro

    event = records.select(from_avro("value", avro_schema(schema)).alias("event"))
    kept = T.StructType([f for f in schema if f.name not in _UNDECODED])
    return cast_to(event.select("event.*"), kept)


def decode_orders(records: DataFrame) -> DataFrame:
    return _decode(records, ORDER_FEED)


def decode_couriers(records: DataFrame) -> DataFrame:
    return _decode(records, COURIER_FEED)


def order_stream(spark: SparkSession, topic: str, connection: Mapping[str, str], **kw) -> DataFrame:
    return decode_orders(read_topic(spark, topic_options(topic, connection, **kw)))


def courier_stream(
    spark: SparkSession, topic: str, connection: Mapping[str, str], **kw
) -> DataFrame:
    return decode_couriers(read_topic(spark, topic_options(topic, connection, **kw)))


def to_records(feed: DataFrame, schema: T.StructType) -> DataFrame:
    """Kafka records of a feed: zone as key, Avro as value."""
    from pyspark.sql.avro.functions import to_avro

    event = F.struct(*schema.fieldNames())
    return cast_to(feed, avro_columns(schema)).select(
        F.col("zone_id").cast("binary").alias("key"),
        to_avro(event, avro_schema(schema)).alias("value"),
    )


def publish(feed: DataFrame, schema: T.StructType, topic: str, connection: Mapping[str, str]):
    """Write a batch feed to a topic."""
    records = to_records(feed, schema)
    records.write.format("kafka").options(**connection).option("topic", topic).save()


def publish_stream(
    records: DataFrame,
    topic: str,
    connection: Mapping[str, str],
    checkpoint: str,
    interval: str | None = None,
    sink: str = "kafka",
) -> StreamingQuery:
    """Write a stream of records (``key``, ``value``) to a topic, with a checkpoint of its own.

    ``interval`` sets a processing-time trigger; without it what is there is sent and the query
    ends.  ``sink``: another format, where the connector is missing.
    """
    writer = records.writeStream.format(sink).options(**connection)
    writer = writer.option("topic", topic).option("checkpointLocation", f"{checkpoint}/{topic}")
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.queryName(f"publish-{topic}").trigger(**trigger).start()
