"""Values of nearby rows within a key, also where one key is very large.

A plain ``lag`` puts all rows of a key into one task.  Here each key is cut
into time slices.  A window looks inside a slice; only the rows at the edges of
a slice then meet the edge rows of other slices.  Rows must be unique per key
and time, so a slice never holds more rows than it has ticks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_MILLIS = 600_000


def _shifted(value: str, offset: int) -> Column:
    return F.lag(value, -offset) if offset < 0 else F.lead(value, offset)


def with_neighbours(
    rows: DataFrame,
    keys: list[str],
    millis: str,
    value: str,
    offsets: Mapping[str, int],
    slice_millis: int = SLICE_MILLIS,
) -> DataFrame:
    """Add a column per offset with ``value`` of the row that many steps away.

    ``offsets`` maps column names to steps in time order, such as
    ``{"previous": -1, "next": 1}``.  ``rows`` holds one row per ``keys`` and
    ``millis``.  Both branches read the same sliced rows, so Spark shuffles
    those once and reuses the exchange.
    """
    reach = max(abs(offset) for offset in offsets.values())
    inside = Window.partitionBy(*keys, "slice").orderBy(millis)
    across = Window.partitionBy(*keys).orderBy(millis)
    sliced = rows.withColumn("slice", F.floor(F.col(millis) / slice_millis)).withColumns(
        {name: _shifted(value, offset).over(inside) for name, offset in offsets.items()}
        | {
            "at_edge": F.lag(millis, reach).over(inside).isNull()
            | F.lead(millis, reach).over(inside).isNull()
        }
    )
    # What an edge row misses lies in another slice, and every row on the way
    # there is an edge row too.
    edges = (
        sliced.filter("at_edge")
        .withColumns(
            {f"{name}_across": _shifted(value, o).over(across) for name, o in offsets.items()}
        )
        .withColumns({name: F.coalesce(name, f"{name}_across") for name in offsets})
        .drop(*[f"{name}_across" for name in offsets])
    )
    return sliced.filter("NOT at_edge").unionByName(edges).drop("slice", "at_edge")


def with_run_before(
    rows: DataFrame, keys: list[str], at: str, state: str, slice_width: int
) -> DataFrame:
    """Add ``previous``, the state of the row before, and ``since``, where the run of that state began.

    A run is a stretch of rows of one state in the order of the integer ``at``; ``rows`` holds one row
    per ``keys`` and ``at``, and neither is null.  Where ``previous`` equals the row's own state, the
    row goes on a run and its ``since`` is not to be read.  Keys are cut into slices of ``at`` as above;
    only the first two and the last row that begin a run in a slice meet those of other slices.
    """
    inside = Window.partitionBy(*keys, "slice").orderBy(at)
    across = Window.partitionBy(*keys).orderBy(at)
    sliced = (
        rows.withColumn("slice", F.floor(F.col(at) / slice_width))
        .withColumn("previous", F.lag(state).over(inside))
        .withColumn("begins", F.col("previous").isNull() | (F.col("previous") != F.col(state)))
        .withColumns(
            {
                "since": _latest(F.when(F.col("begins"), F.col(at)), inside),
                "run": F.count_if("begins").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            }
        )
        .withColumn("runs", F.max("run").over(Window.partitionBy(*keys, "slice")))
        .withColumn("at_edge", F.col("begins") & ((F.col("run") <= 2) | (F.col("run") == F.col("runs"))))
    )
    before = F.lag(state).over(across)
    edges = (
        sliced.filter("at_edge")
        .withColumn("before", before)
        # in a slice, only its first row can go on with a run that began before
        .withColumn("new", (F.col("run") > 1) | F.col("before").isNull() | (F.col("before") != F.col(state)))
        .withColumn("began", _latest(F.when(F.col("new"), F.col(at)), across))
        .withColumns(
            {
                "previous": F.when(F.col("run") == 1, F.col("before")).otherwise(F.col("previous")),
                "since": F.when(F.col("run") <= 2, F.col("began")).otherwise(F.col("since")),
            }
        )
        .drop("before", "new", "began")
    )
    found = sliced.filter("NOT at_edge").unionByName(edges)
    return found.drop("slice", "begins", "run", "runs", "at_edge")


def _latest(value: Column, window) -> Column:
    """The last value before a row that is not null."""
    return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))
