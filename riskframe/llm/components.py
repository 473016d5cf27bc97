"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a join and a pre-aggregated minimum, so a node with a third of all
edges is no burden for one task; each round is written to the shared folder, which cuts
the lineage. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stored


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node, and the node's least neighbour (itself included)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    larger = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return larger.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, joined to the least of them. Edges run from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node of an edge (columns a, b), the least node it can reach.

    Loops and repeated edges are ignored; edges with a NULL end too; nodes without a real edge are absent.
    """
    start = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(start.filter("a is not null and b is not null and a <> b").distinct(), "edges")
    before = _summary(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        after = _summary(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
