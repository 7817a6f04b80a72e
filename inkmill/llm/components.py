"""Connected components of an edge table, by alternating star contractions.

Each step points every node at the smallest neighbour it knows: first the larger neighbours, then the smaller
ones. Only minima per node are aggregated, with partial sums before the shuffle, so a node with many neighbours
is no hot key there; the join back has the single minimum on its other side, and adaptive execution splits the
large one. Steps are written to the shared folder, and only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component``, the smallest node it can reach, for every node of an edge.

    Edges with a null end are no edges. A node with an edge to itself only is its own component. Repeated edges and
    both directions count once. No edges give an empty table.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL").distinct()
    pairs = cut_lineage(pairs)
    now = pairs.filter("a <> b")
    mark = None
    while True:
        now = cut_lineage(_small_star(_large_star(now)))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            break
        mark = tuple(seen)
    own = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    return own.join(now.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))
