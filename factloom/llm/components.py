"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges between longs -> (node, label), one row per node that has an edge.

    Each round lets every node follow its smallest neighbour and keeps the edges that still
    lead elsewhere; with ids that are hashes a round removes a good part of the nodes. Minima
    combine before the shuffle; rounds end when no edge is left.
    """
    spark = edges.sparkSession
    left = edges.select("a", "b").filter("a != b")
    labels = None
    while True:
        left = stored(spark, left.distinct(), "edges")
        if left.isEmpty():
            break
        both = left.union(left.select("b", "a"))
        follow = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        follow = follow.select("node", F.least("node", "b").alias("to"))
        follow = stored(spark, follow, "follow")
        if labels is None:
            labels = follow.select("node", F.col("to").alias("label"))
        else:
            step = follow.select(F.col("node").alias("label"), "to")
            labels = labels.join(step, "label", "left").select(
                "node", F.coalesce("to", "label").alias("label")
            )
            labels = stored(spark, labels, "labels")
        left = (
            left.join(follow.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(follow.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .filter("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        )
    return labels if labels is not None else spark.createDataFrame([], "node long, label long")
