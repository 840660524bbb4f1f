"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for all ends of ``a, b``: the smallest node that is reachable.

    Union by contraction: every node joins its smallest neighbour, edges are renamed and those
    inside a node vanish, until none is left. At least half of the nodes that still have an edge
    go in each round. All tables stay distributed and each round is written, so that a lost
    executor costs one round at most.
    """
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    node = F.explode(F.array("a", "b")).alias("node")
    labels = stored(edges.select(node).distinct().withColumn("component", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy("a").agg(F.least("a", F.min("b")).alias("parent"))
        parents = stored(parents.filter("parent < a"), "parents")
        # A parent can have joined a smaller node in the same round; later rounds follow it.
        left = edges.join(parents, "a", "left").select(
            F.coalesce("parent", "a").alias("x"), F.col("b").alias("a")
        )
        both_ends = left.join(parents, "a", "left").select(
            "x", F.coalesce("parent", "a").alias("y")
        )
        chains = parents.select("a", F.col("parent").alias("b"))
        chains = chains.join(
            parents.select(F.col("a").alias("b"), F.col("parent").alias("further")), "b"
        ).select(F.col("b").alias("x"), F.col("further").alias("y"))
        renamed = both_ends.unionByName(chains).filter("x <> y")
        renamed = renamed.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        labels = stored(
            labels.join(parents.withColumnRenamed("a", "component"), "component", "left").select(
                "node", F.coalesce("parent", "component").alias("component")
            ),
            "labels",
        )
        edges = stored(renamed.distinct(), "edges")
    return labels
