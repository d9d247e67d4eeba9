"""Connected components of an edge table, by contracting it until no edge is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.store import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); nodes outside have no row.

    In each round every node moves to its least neighbour, edges follow their ends,
    and those inside one node go. A component with edges loses at least one node a
    round, half of them as a rule; the rounds end when no edge is left. The name of
    a component is one of its nodes.
    """
    left = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mapping = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b"), F.col("a")))
        # A node's least neighbour or itself; made from the edges alone.
        step = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")), "step")
        if mapping is None:
            mapping = step.select(F.col("a").alias("node"), F.col("to").alias("component"))
        else:
            move = step.select(F.col("a").alias("component"), "to")
            mapping = written(mapping.join(move, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")), "mapping")
        one = step.select("a", F.col("to").alias("x"))
        other = step.select(F.col("a").alias("b"), F.col("to").alias("y"))
        left = written(left.join(one, "a").join(other, "b").filter("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if mapping is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return mapping
