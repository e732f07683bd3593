"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.operators.windows import write_once


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges(a, b)``; the label is the least node reached.

    Each round takes the least label among the neighbours and then the label of that label,
    so paths shorten by half. Only the edge and label tables are ever shuffled; rounds end
    when no label changes. Labels are stored in the shared folder after each round.
    """
    both = edges.where(F.col("a") != F.col("b"))
    both = write_once(both.union(both.select("b", "a")).toDF("a", "b").distinct(), "edges")
    labels = write_once(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a"), "left").select("node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        found = write_once(lower.join(jump, "low", "left").select("node", "old", F.least("low", F.coalesce("far", "low")).alias("label")), "labels")
        labels = found.select("node", "label")
        if found.where(F.col("old") != F.col("label")).isEmpty():
            return labels
