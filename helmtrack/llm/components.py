"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helmtrack.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, label): the label is the least node of its component. Each round takes the
    least label of a node's neighbours, then the label of its label, so that long chains shorten by halves.
    Nothing comes to the driver but whether a label changed; each round is written to the shared folder."""
    edges = edges.where("a <> b").select("a", "b")
    both = written(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("at")).agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("at"), "left").select("node", F.col("label").alias("was"), F.least("label", F.coalesce("near", "label")).alias("label"))
        jump = labels.select(F.col("node").alias("over"), F.col("label").alias("beyond"))
        after = lower.join(jump, F.col("label") == F.col("over"), "left").select("node", "was", F.least("label", F.coalesce("beyond", "label")).alias("label"))
        after = written(after, "labels")
        labels = after.select("node", "label")
        if after.where("label <> was").isEmpty():
            return labels
