"""Connected components of an edge table by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.session import materialise


def connected(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root) for every node with an edge; root is the component's smallest node.

    Each round takes the smallest label among a node and its neighbours, then the label of that label.
    Rounds are stored tables, so the plan does not grow; the driver sees one count a round.
    """
    stored = materialise(edges.select("a", "b"))
    both = materialise(stored.unionByName(stored.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")))
    while True:
        seen = both.join(labels.select(F.col("node").alias("a"), F.col("root").alias("near")), "a")
        least = seen.groupBy(F.col("b").alias("node")).agg(F.min("near").alias("near"))
        hooked = labels.join(least, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        moved = materialise(hooked.join(jump, "root", "left").select("node", "old", F.least("root", "far").alias("root")))
        if moved.filter("old <> root").isEmpty():
            return moved.select("node", "root")
        labels = moved.select("node", "root")
