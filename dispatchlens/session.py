"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SCRATCH_CONF = "spark.dispatchlens.scratch"
TIME_ZONE_CONF = "spark.sql.session.timeZone"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def create_session(app_name: str, master: str | None = None, **confs: str) -> SparkSession:
    """A session for this library; cluster settings come from the caller."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    builder = builder.config(TIME_ZONE_CONF, "UTC")
    if master:
        builder = builder.master(master)
    for key, value in confs.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """A session in which windows and dates are in UTC: the given one if it is so, else a new one
    of the same application.  The caller's session is left as it is."""
    if spark.conf.get(TIME_ZONE_CONF) == "UTC":
        return spark
    session = spark.newSession()
    session.conf.set(TIME_ZONE_CONF, "UTC")
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate data that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``, or the caller in ``spark.dispatchlens.scratch``;
    without either it lies in the warehouse, which executors share as well.  No setting is changed.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.conf.get(SCRATCH_CONF, None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/dispatchlens-scratch"
    return base.rstrip("/")


def new_run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A setting of a session for the length of a block; then it is as before."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def streaming_session(spark: SparkSession, rocksdb: bool = True) -> SparkSession:
    """A session of the same application tuned for stateful queries.

    The shuffle width of a stateful query is frozen in its checkpoint on first start and is not
    adapted at run time, so it is the caller's to choose; it is taken over from their session.
    """
    session = prepare(spark.newSession())
    width = "spark.sql.shuffle.partitions"
    session.conf.set(width, spark.conf.get(width))
    session.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"
    )
    # what a batch has shuffled is not read again once the batch has ended
    session.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    if rocksdb:
        store = "spark.sql.streaming.stateStore"
        session.conf.set(f"{store}.providerClass", ROCKSDB)
        # a commit uploads the changes of the batch, not whole state files
        session.conf.set(f"{store}.rocksdb.changelogCheckpointing.enabled", "true")
        session.conf.set(f"{store}.compression.codec", "zstd")
        # a join keeps its state in one store per partition instead of four
        session.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")
    return session
