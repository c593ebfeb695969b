"""Connected components of links between rows, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subjectloom.session import written


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links (a, b)``; the label is a node of the component,
    the same for all of it.

    Each round points every node to its smallest neighbour (or itself), follows the pointers
    twice, and replaces the ends of all links by where they lead. A star is one node after one
    round, a chain shrinks by a factor of four or more, so rounds grow with the logarithm of
    the longest path. Rounds are written to the shared folder. A node with very many links is
    aggregated before the shuffle, and the join that moves its links can be split.
    """
    edges = links.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    edges = written(edges.distinct(), "links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = written(nodes.select("node", F.col("node").alias("label")), "labels")
    while not edges.isEmpty():
        ends = edges.select(F.col("b").alias("node"), F.col("a").alias("to")).union(
            edges.select("a", "b")
        )
        parents = ends.groupBy("node").agg(F.min("to").alias("to"))
        parents = written(parents.select("node", F.least("node", "to").alias("to")), "parents")
        for _ in range(2):
            further = parents.select(F.col("node").alias("to"), F.col("to").alias("next"))
            parents = parents.join(further, "to", "left").select(
                "node", F.coalesce("next", "to").alias("to")
            )
        parents = written(parents, "parents")
        labels = written(
            labels.join(parents.withColumnRenamed("node", "label"), "label", "left").select(
                "node", F.coalesce("to", "label").alias("label")
            ),
            "labels",
        )
        moved = edges.join(parents.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        moved = moved.join(parents.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        moved = moved.where("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
        )
        edges = written(moved.distinct(), "links")
    return labels
