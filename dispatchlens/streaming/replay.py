"""Replay finite feeds through the streaming operators, in time order and many batches.

A feed is cut at quantiles of its event time into slices, and each slice is written as the next files
of a folder that the stream reads batch by batch.  A finite stream never closes its last windows,
because nothing moves the watermark past them; the last file therefore holds flush rows: events
long after the last one of all feeds that pass the filters of every analytic.  Their own windows stay
open, so they never show in a windowed result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.catalog import ANALYTICS
from ..schemas import COURIER_FEED, ORDER_FEED, as_nullable, result_schema
from ..session import new_run_folder, setting, streaming_session
from .incremental import merge_stream
from .runner import finish_all, parquet_sink

FLUSH_ID = "__flush__"
#: from the last time in the feeds to the flush rows, in microseconds: more than any state waits
_FLUSH_AFTER = 366 * 86_400 * 1_000_000
#: partitions of state for each core, if the caller's session has no fewer
_STORES_PER_CORE = 3
_FEEDS = {
    "orders": (ORDER_FEED, "order_status", ("PLACED", "READY_FOR_PICKUP", "DELIVERED")),
    "couriers": (COURIER_FEED, "courier_status", ("ONLINE_IDLE",)),
}
_FLUSH_DEFAULTS = {
    T.StringType: f"'{FLUSH_ID}'",
    T.BooleanType: "false",
    T.IntegerType: "1000000",
    T.LongType: "1000000",
}


def _flush_rows(spark: SparkSession, name: str, micros: int) -> DataFrame:
    """One row per status in which every scalar column but the rating is set, all times to ``micros``."""
    feed, status, values = _FEEDS[name]
    defaults = _FLUSH_DEFAULTS | {T.TimestampType: f"timestamp_micros({micros})"}
    columns = [
        F.expr(
            f"explode(array({', '.join(repr(v) for v in values)}))"
            if f.name == status
            else f"cast({defaults.get(type(f.dataType), 'NULL')} AS {f.dataType.simpleString()})"
        ).alias(f.name)
        for f in feed
    ]
    return spark.range(1).select(*columns)


def dropped_rows(progress: Sequence[Mapping]) -> int:
    """Rows, after combining, that came behind the watermark in the batches of a query."""
    return sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])


class Replay:
    """Runs streaming operators over finite feeds, one run per object.

    ``slices``: data batches at least; ``order_by``: time that tells which slice a row belongs to;
    ``files``: files per slice, which are read together, of neighbouring partitions of the feed: a feed that lies
    in the order of time is dealt out before; ``cuts``: the times between slices in
    microseconds, in their order, instead of quantiles; every slice is a batch then, also an empty one;
    ``flush``: whether all windows are closed in the end, or stay open as on a stream that goes on;
    ``state_totals``: whether progress tells how many rows a state holds, which takes a look-up for each change.
    """

    def __init__(
        self,
        spark: SparkSession,
        feeds: Mapping[str, DataFrame],
        slices: int = 4,
        order_by: str = "event_timestamp",
        files: int = 1,
        rocksdb: bool = True,
        cuts: Sequence[int] | None = None,
        flush: bool = True,
        state_totals: bool = True,
    ):
        self.spark, self.feeds = spark, feeds
        self.cuts, self.flush = cuts, flush
        slices = slices if cuts is None else len(cuts) + 1
        self.slices, self.order_by, self.files = slices, order_by, files
        self.session = streaming_session(spark, rocksdb)
        if rocksdb:
            # every batch opens and commits all stores, which costs more than the rows of small ones; rows of
            # large ones are on disk
            width, cores = "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism
            totals = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
            self.session.conf.set(totals, str(state_totals).lower())
            self.session.conf.set(width, min(int(spark.conf.get(width)), _STORES_PER_CORE * cores))
        self.folder = new_run_folder(spark, "replay")
        self.progress: list = []
        self._latest: dict[str, int] = {}  # last time in each feed that is written
        self._flushed: set[str] = set()

    def _write(self, name: str) -> None:
        """The feed's slices, which one pass over the feed writes, each by as many tasks as it has files."""
        schema, *_ = _FEEDS[name]
        feed = self.feeds[name].select(*schema.fieldNames())
        time = F.unix_micros(self.order_by)
        shares = F.array(*(F.lit(i / self.slices) for i in range(1, self.slices)))
        times = [F.unix_micros(f.name) for f in schema if isinstance(f.dataType, T.TimestampType)]
        found = feed.agg(
            F.percentile_approx(time, shares).alias("b"), F.max(F.greatest(*times)).alias("latest")
        ).first()
        self._latest[name] = found["latest"] or 0
        cuts = (found["b"] or []) if self.cuts is None else self.cuts
        number = sum((F.when(time > cut, 1).otherwise(0) for cut in cuts), F.lit(0))
        made = f"{self.folder}/made-{name}"
        # a task keeps a file open for each slice, so that rows need not be sorted by slice
        with setting(self.spark, "spark.sql.maxConcurrentOutputFileWriters", self.slices + 1):
            feed.withColumn("slice", number).coalesce(self.files).write.partitionBy("slice").parquet(made, compression="zstd")
        for i in range(self.slices):
            self._fill_up(f"{made}/slice={i}", feed)
        self._arrive(made, f"{self.folder}/{name}")

    def _fill_up(self, path: str, feed: DataFrame) -> None:
        """Empty files in a slice of few rows, so that the next one starts a batch of its own."""
        for _ in range(self.files - len(self._parts(path))):
            feed.limit(0).coalesce(1).write.mode("append").parquet(path)

    def _path(self, path: str) -> JavaObject:
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self) -> JavaObject:
        return self._path(self.folder).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _parts(self, path: str) -> list[JavaObject]:
        """The data files of a folder, as told by its store."""
        return list(self._system().globStatus(self._path(f"{path}/part-*")) or [])

    def _arrive(self, made: str, folder: str) -> None:
        """Slices go into the folder that a stream reads, which takes files by their times: those of a slice get one
        time, before those of the next slice and of what is written later."""
        system = self._system()
        slices = [self._parts(f"{made}/slice={i}") for i in range(self.slices)]
        last = max(part.getModificationTime() for parts in slices for part in parts)
        system.mkdirs(self._path(folder))
        for i, parts in enumerate(slices):
            at, arrived = last - 1000 * (self.slices - i), []
            for part in parts:
                arrived.append(self._path(f"{folder}/{i}-{part.getPath().getName()}"))
                system.rename(part.getPath(), arrived[-1])
                system.setTimes(arrived[-1], at, -1)
            if any(system.getFileStatus(path).getModificationTime() != at for path in arrived):
                raise OSError(f"slices cannot be put in order: no times of files can be set in {folder}")

    def _append(self, name: str, rows: DataFrame) -> None:
        rows.coalesce(self.files).write.mode("append").parquet(f"{self.folder}/{name}")

    def _flush(self) -> None:
        """The flush rows of the feeds in use, at one time after the last of all."""
        if not self.flush:
            return
        micros = max(self._latest.values(), default=0) + _FLUSH_AFTER
        for name in self._latest.keys() - self._flushed:
            self._append(name, _flush_rows(self.spark, name, micros).select(*_FEEDS[name][0].fieldNames()))
            self._flushed.add(name)

    def _stream(self, name: str) -> DataFrame:
        if name not in self._latest:
            self._write(name)
        reader = self.session.readStream.schema(as_nullable(_FEEDS[name][0]))
        return reader.option("maxFilesPerTrigger", self.files).parquet(f"{self.folder}/{name}")

    def orders(self) -> DataFrame:
        return self._stream("orders")

    def couriers(self) -> DataFrame:
        return self._stream("couriers")

    def start(self, results: DataFrame, name: str, partition_by=()) -> StreamingQuery:
        """Start a streaming result, which ends with the feeds."""
        self._flush()
        output, checkpoints = f"{self.folder}/output", f"{self.folder}/checkpoints"
        return parquet_sink(results, name, output, checkpoints, partition_by, available_now=True)

    def stored(self, results: DataFrame, name: str) -> DataFrame:
        """What the sink of a result holds."""
        return self.spark.read.schema(as_nullable(results.schema)).parquet(f"{self.folder}/output/{name}")

    def run(self, results: DataFrame, name: str, partition_by=()) -> DataFrame:
        """Run a streaming result to its end and return what the sink holds."""
        query = self.start(results, name, partition_by)
        finish_all([query])
        self.progress = list(query.recentProgress)
        return self.stored(results, name)

    def merge(self, results: DataFrame, merge: Callable[[DataFrame, int], None], name: str) -> None:
        """Run a streaming result to its end, batch by batch, into ``merge``."""
        self._flush()
        query = merge_stream(results, merge, name, f"{self.folder}/checkpoints", available_now=True)
        finish_all([query])
        self.progress = list(query.recentProgress)

    def checkpoint(self, name: str) -> str:
        return f"{self.folder}/checkpoints/{name}"

    def data_batches(self) -> int:
        """Batches of the last run that had rows."""
        return sum(p["numInputRows"] > 0 for p in self.progress)

    def dropped_rows(self) -> int:
        """Rows, after combining, that came behind the watermark in the last run."""
        return dropped_rows(self.progress)

    def analytic(self, name: str) -> DataFrame:
        """One of the nine analytics, with the result table's own sink."""
        analytic = ANALYTICS[name]
        frames = {feed: getattr(self, feed)() for feed in analytic.feeds}
        stored = self.run(analytic(frames), name, ("window_date",))
        return stored.select(*result_schema(name).fieldNames())
