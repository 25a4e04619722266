"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tianguis.llm.staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = staged(both.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    return moved.filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = staged(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b); the component is its smallest node.

    Large and small star in turn until the edges stay the same, which takes a number of rounds that grows with the
    logarithm of the nodes. A round aggregates and joins on nodes, so a node with very many edges is one line per task
    in the sums; these are staged, so that the join with them can split it. Edges never grow in number, and each round's
    are staged.
    """
    state = lambda e: e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    edges = staged(edges.select("a", "b").filter("a != b").distinct(), "edges")
    before = state(edges)
    while before[0]:
        edges = staged(_small_star(_large_star(edges)), "edges")
        now = state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
