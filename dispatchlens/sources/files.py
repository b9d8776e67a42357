"""Feeds and results as files: JSON lines, parquet and Avro containers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.rollups import within_dates
from ..schemas import as_nullable, avro_columns, avro_schema, enum_columns, result_schema

# Spark's own Avro files; by class, as the short name needs the spark-avro package
AVRO = "org.apache.spark.sql.avro.AvroFileFormat"
FEED_DATE = "event_date"


def _wire_schema(feed: T.StructType) -> T.StructType:
    """The feed as it looks in JSON: times are epoch milliseconds."""
    return T.StructType(
        [
            T.StructField(
                f.name, T.LongType() if isinstance(f.dataType, T.TimestampType) else f.dataType
            )
            for f in feed
        ]
    )


def _convert_times(df: DataFrame, feed: T.StructType, convert) -> DataFrame:
    return df.select(
        *[
            convert(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in feed
        ]
    )


def write_json_lines(
    feed: DataFrame, path: str, schema: T.StructType, mode: str = "errorifexists", compression: str = "gzip"
):
    """Write a feed as JSON lines; null fields are written out as null.

    Lines repeat all names, so files are compressed; readers tell that by the name of a file.
    """
    wire = _convert_times(feed, schema, F.unix_millis)
    wire.write.mode(mode).option("ignoreNullFields", "false").option("compression", compression).json(path)


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, streaming: bool = False
) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return _convert_times(reader.schema(_wire_schema(schema)).json(path), schema, F.timestamp_millis)


def write_feed(feed: DataFrame, path: str, mode: str = "errorifexists"):
    """Keep a feed as parquet, partitioned by the date of its events."""
    dated = feed.withColumn(FEED_DATE, F.to_date("event_timestamp"))
    dated.hint("rebalance", FEED_DATE).write.mode(mode).partitionBy(FEED_DATE).parquet(path)


def read_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    streaming: bool = False,
    first_date: str | None = None,
    last_date: str | None = None,
    **options: str,
) -> DataFrame:
    """A feed kept as parquet.  Streams take options such as maxFilesPerTrigger.

    Date bounds prune folders, so they need a feed that ``write_feed`` has stored.
    """
    reader = spark.readStream if streaming else spark.read
    if first_date is None and last_date is None:
        stored = reader.schema(as_nullable(schema)).options(**options).parquet(path)
        return stored.select(*schema.fieldNames())
    dated = as_nullable(schema).add(FEED_DATE, T.DateType())
    stored = reader.schema(dated).options(**options).parquet(path)
    return within_dates(stored, first_date, last_date, FEED_DATE).select(*schema.fieldNames())


def cast_to(feed: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema, in its order and with its types, all nullable."""
    return feed.select(
        *[F.col(f.name).cast(f.dataType.simpleString()).alias(f.name) for f in schema]
    )


def write_avro(feed: DataFrame, path: str, schema: T.StructType, mode: str = "errorifexists"):
    """Write a feed as Avro container files.

    Avro holds no value outside an enum: it is written as null where the contract has null, and
    raises elsewhere.
    """
    symbols = enum_columns(schema)
    known = {
        f.name: F.when(F.col(f.name).isin(symbols[f.name]), F.col(f.name))
        for f in schema
        if f.name in symbols and f.nullable
    }
    wire = cast_to(feed.withColumns(known), avro_columns(schema))
    wire.write.format(AVRO).mode(mode).option("avroSchema", avro_schema(schema)).save(path)


def read_avro(
    spark: SparkSession, path: str, schema: T.StructType, streaming: bool = False
) -> DataFrame:
    """A feed kept as Avro container files, whatever names its writer gave the types."""
    reader = spark.readStream if streaming else spark.read
    return cast_to(reader.format(AVRO).schema(avro_columns(schema)).load(path), schema)


def write_results(results: DataFrame, base: str, name: str):
    """Write a result table to its dataset, partitioned by date.

    The dates at hand replace what the dataset had for them, and other dates stay, so that a
    batch can run again.  Rows of a date go to one task, or a few where they are many.
    """
    writer = results.hint("rebalance", "window_date").write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("window_date")
    writer.parquet(f"{base.rstrip('/')}/{name}")


def read_results(
    spark: SparkSession,
    base: str,
    name: str,
    first_date: str | None = None,
    last_date: str | None = None,
) -> DataFrame:
    """A result dataset, or an empty frame of its schema if nothing was written.

    Date bounds prune partitions, so a report over a few days reads only those.
    """
    schema = result_schema(name)
    try:
        stored = spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], schema)
    return within_dates(stored, first_date, last_date).select(*schema.fieldNames())
