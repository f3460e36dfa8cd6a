"""Connected components of links; nothing reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.session import observed


def _to_least(edges: DataFrame) -> DataFrame:
    """Every node ties its neighbours and itself to the least of them. Edges are (a, b), b below a."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    tied = both.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return tied.filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node that has a link; label is the least node of its component. links: (a, b), in any order, repeated or not.

    A round ties every neighbourhood to its least node and is written and read back; the distance to the least node of a component halves at least, and the rounds end when one changes
    nothing. A node with a third of all links is a sum and a join, never one group.
    """
    seen = {"n": F.count(F.lit(1)), "h": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))}
    edges, state = observed(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), **seen)
    while state["n"]:
        before = state
        edges, state = observed(_to_least(edges), **seen)
        if state == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
