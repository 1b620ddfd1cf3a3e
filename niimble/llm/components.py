"""Connected components of a graph given as edges, by alternating stars.

A large star hangs every greater neighbour of a node on the smallest node around; a small star does so
with the smaller neighbours. Both keep components as they are, and after some rounds each component is
one star around its smallest node. Edges are never gathered by node: minima are combined before their
shuffle and joined back. Each round is written, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niimble.llm.frames import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").where(F.col("b") != F.col("least"))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        least.select("a", F.col("least").alias("b"))
    )


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` of ``a, b`` (whole numbers): every node that has an edge to another, and the smallest node
    of its component. Roots are listed too. Repeated edges, both directions and loops do no harm."""
    current = edges.where(F.col("a") != F.col("b")).select("a", "b").distinct()
    state = None
    while True:
        current = materialize(_small_star(_large_star(current)).where(F.col("a") != F.col("b")).distinct(), "stars")
        row = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
