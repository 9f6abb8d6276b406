"""Connected components of an edge table, in a number of rounds that grows with the logarithm of its diameter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node of its component.

    Every round hooks each node, and the root it points to, below the smallest grandparent among its
    neighbours, then halves the paths. A round is one table in the shared folder, so a lost executor
    costs a part of one round. A hub is a skewed join key that Spark splits, and minima are combined
    before they are shuffled. Nodes without an edge are not returned; an empty table gives an empty one.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = staged(both.where("a <> b").distinct(), "pairs")
    labels = staged(pairs.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("grand"))
        known = labels.join(up, "root").select("node", "root", "grand")
        near = pairs.join(known.select(F.col("node").alias("b"), "grand"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("grand").alias("low"))
        hooks = known.join(near, "node").select(
            F.explode(F.array(F.struct("node", F.least("grand", "low").alias("value")),
                              F.struct(F.col("root").alias("node"), F.col("low").alias("value")))).alias("h"))
        fresh = staged(hooks.select("h.*").groupBy("node").agg(F.min("value").alias("root")), "labels")
        moved = fresh.join(labels.withColumnRenamed("root", "old"), "node").where("root <> old")
        labels = fresh
        if moved.isEmpty():
            return labels
