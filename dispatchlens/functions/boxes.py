"""Points in boxes by a grid, for tables of boxes of any number.

A box is laid on the cells of a grid that it covers, on the finest of a few levels at which these are
not many; a point lies in one cell of each level.  Points and boxes meet by equal cells, and the
exact test follows.  Points of a cell are spread over several keys, and its boxes repeated for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: cell widths in degrees, the finest first; no box is wider than a few of the last
LEVELS = (0.01, 0.1, 1.0, 10.0, 360.0)
#: a box takes the first level at which it covers no more cells than this
MOST_CELLS = 16
SPREAD = 8
BOX = ("lat_lo", "lat_hi", "lon_lo", "lon_hi")


def _cell(value: Column, width: Column | float) -> Column:
    return F.floor(value / width)


def _levels_of_boxes(boxes: DataFrame, levels: tuple[float, ...]) -> DataFrame:
    def cells(width: float) -> Column:
        span = lambda lo, hi: _cell(F.col(hi), width) - _cell(F.col(lo), width) + 1
        return span("lat_lo", "lat_hi") * span("lon_lo", "lon_hi")

    level = F.lit(len(levels) - 1)
    for i in reversed(range(len(levels) - 1)):
        level = F.when(cells(levels[i]) <= MOST_CELLS, i).otherwise(level)
    return boxes.withColumn("level", level)


def box_of_points(
    points: DataFrame,
    boxes: DataFrame,
    box_id: str = "box_id",
    lat: str = "lat",
    lon: str = "lon",
    levels: tuple[float, ...] = LEVELS,
    spread: int = SPREAD,
) -> DataFrame:
    """Add ``box_id`` of the box that holds each point, null outside of all.

    Boxes are half-open in both directions; ``boxes`` holds ``BOX``, the id and ``rank``: of several
    boxes the one of lowest rank holds the point.  Rows of ``points`` must differ from each other,
    so count equal ones first.  A box without area, or with a null edge, holds nothing.
    """
    widths = F.array(*map(F.lit, levels))
    width = widths[F.col("level")]
    steps = lambda lo, hi: F.explode(F.sequence(_cell(F.col(lo), width), _cell(F.col(hi), width)))
    real = (F.col("lat_lo") < F.col("lat_hi")) & (F.col("lon_lo") < F.col("lon_hi"))
    laid = (
        _levels_of_boxes(boxes.filter(real), levels)
        .select(F.col(box_id).alias("held_by"), "rank", *BOX, "level", steps("lat_lo", "lat_hi").alias("y"))
        .select("*", F.explode(F.sequence(*(_cell(F.col(c), width) for c in ("lon_lo", "lon_hi")))).alias("x"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part"))
    )
    own = points.columns
    part = F.pmod(F.xxhash64(*own), F.lit(spread)).cast("int").alias("part")
    each = F.explode(F.sequence(F.lit(0), F.lit(len(levels) - 1))).alias("level")
    dealt = points.select("*", part, each).select(
        "*", _cell(F.col(lat), width).alias("y"), _cell(F.col(lon), width).alias("x")
    )
    there = (
        dealt.alias("p")
        .join(laid.alias("b"), ["level", "y", "x", "part"], "left")
        .withColumn(
            "inside",
            (F.col(lat) >= F.col("lat_lo")) & (F.col(lat) < F.col("lat_hi"))
            & (F.col(lon) >= F.col("lon_lo")) & (F.col(lon) < F.col("lon_hi")),
        )
    )
    best = F.min(F.when(F.col("inside"), F.struct("rank", "held_by"))).alias("best")
    return there.groupBy(*own).agg(best).select(*own, F.col("best.held_by").alias(box_id))
