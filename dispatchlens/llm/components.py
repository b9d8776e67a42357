"""Connected components of edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispatchlens.llm.frames import stored


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``label``) for all ends of ``edges`` (columns ``a`` and ``b``).

    The label is the lowest node of the component.

    Each round takes the lowest label among a node's neighbours and then the label of that label,
    so that labels travel twice as far every round; a round is written out before the next.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct()
    both = stored(both.where(F.col("a") != F.col("b")), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "label"), "b")
        lowest = (
            around.select(F.col("a").alias("node"), "label")
            .union(labels)
            .groupBy("node")
            .agg(F.min("label").alias("low"))
        )
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("lower"))
        new = lowest.join(jump, "low").join(labels, "node")
        label = F.least("low", "lower").alias("label")
        new = new.select("node", label, F.col("label").alias("old"))
        new = stored(new, "labels")
        labels = new.select("node", "label")
        if new.where("label != old").isEmpty():
            return labels
