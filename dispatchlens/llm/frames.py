"""Table access and column handling shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchlens.session import new_run_folder


def read(spark: SparkSession, tables: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{tables}/{name}.parquet")


def tidy(df: DataFrame, need: Iterable[str], made: Iterable[str] = ()) -> DataFrame:
    """``df`` with columns that can all be named without doubt.

    The columns in ``need`` must be there.  Of columns whose names differ in case only, or not
    at all, the first stays (one spelled as in ``need`` before others); columns named like one of
    ``made``, which the operator is about to add, go.
    """
    need, gone = list(need), {name.lower() for name in made}
    for name in need:
        if name.lower() not in {c.lower() for c in df.columns}:
            raise ValueError(f"column {name!r} is missing; there are {df.columns}")
    exact = {c for c in need if c in df.columns}
    kept: dict[str, int] = {}
    for i, c in enumerate(df.columns):
        low = c.lower()
        wanted = next((n for n in need if n.lower() == low), None)
        if wanted is None and low in gone:
            continue
        if low not in kept or (c in exact and df.columns[kept[low]] not in exact):
            kept[low] = i
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    spell = {n.lower(): n for n in need}
    return plain.select(
        *(F.col(f"c{i}").alias(spell.get(low, df.columns[i])) for low, i in kept.items())
    )


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a cut of lineage that survives losses."""
    path = new_run_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0))
