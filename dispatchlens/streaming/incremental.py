"""Reports kept up to date by a stream: partial sums per batch, merged when they are read.

Each batch of a result stream writes its sums to a file of its own, named by the batch's number.  A batch
that comes again, after a failure, writes the same file again and changes nothing.  Every so many batches the
sums so far are folded into one snapshot, and batches up to its number are settled: they are no
longer read, nor written should they come again.  A report reads one snapshot and a few files, however
long the stream has been running.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: files of parts that wait for the next snapshot
FOLD_EVERY = 20


class PartialSums:
    """Sums by key over all batches of a stream, in a folder that any executor can reach.

    ``parts`` turns rows of a batch into sums per ``keys``; its other columns are whole numbers to add up.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        parts: Callable[[DataFrame], DataFrame],
        keys: tuple[str, ...] = (),
        fold_every: int = FOLD_EVERY,
    ):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts
        self.keys, self.fold_every = list(keys), fold_every

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the complete files of a kind: those that their writer has closed."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        pattern = hadoop.Path(f"{self.path}/{kind}-*/_SUCCESS")
        system = pattern.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        found = system.globStatus(pattern) or []
        return sorted(int(re.search(rf"/{kind}-(\d+)/", str(f.getPath().toString()))[1]) for f in found)

    def settled(self) -> int:
        """The last batch that the latest snapshot holds, -1 for none."""
        return max(self._numbers("upto"), default=-1)

    def merge(self, rows: DataFrame, batch: int) -> None:
        """Take in a batch of the stream; to be given to ``foreachBatch``."""
        settled = self.settled()
        if batch <= settled:
            return
        self.parts(rows).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch-{batch}")
        if batch - settled >= self.fold_every:
            # only what is certain never to change: this batch may still come again
            self._fold(batch - 1)

    def _fold(self, upto: int) -> None:
        self._sums(upto).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/upto-{upto}")

    def _sums(self, last: int | None = None) -> DataFrame | None:
        settled = self.settled()
        files = [f"{self.path}/upto-{settled}"] if settled >= 0 else []
        files += [
            f"{self.path}/batch-{n}" for n in self._numbers("batch") if n > settled and (last is None or n <= last)
        ]
        if not files:
            return None
        held = self.spark.read.schema(self.spark.read.parquet(files[0]).schema).parquet(*files)
        sums = [F.sum(c).alias(c) for c in held.columns if c not in self.keys]
        return held.groupBy(*self.keys).agg(*sums) if self.keys else held.agg(*sums)

    def read(self) -> DataFrame:
        """The sums over all batches so far, one row per key."""
        sums = self._sums()
        if sums is None:
            raise ValueError(f"no batch of the stream has been merged into {self.path}")
        return sums


def merge_stream(
    results: DataFrame,
    merge: Callable[[DataFrame, int], None],
    name: str,
    checkpoint_base: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Give each batch of a result stream to ``merge``, such as that of partial sums."""
    writer = (
        results.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint_base.rstrip('/')}/{name}")
        .foreachBatch(merge)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
