"""Connected components of an edge table by contraction; every step is a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.operators.materialize import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); the label is one node of its component.

    In a round each node moves to its smallest neighbour and the edges are rewritten between the
    chosen nodes. Node keys should be hashes: then chains are short and few rounds are needed.
    """
    current = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    label = None
    while not current.isEmpty():
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialize(both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")), "parents")
        moved = (
            current.join(parent.withColumnRenamed("p", "pa"), "a")
            .join(parent.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
        current = materialize(moved, "edges")
        if label is None:
            label = parent.select(F.col("a").alias("node"), F.col("p").alias("label"))
        else:
            step = parent.select(F.col("a").alias("label"), "p")
            label = label.join(step, "label", "left").select("node", F.coalesce("p", "label").alias("label"))
    if label is None:
        return current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return materialize(label, "labels")
