"""Connected components by alternating stars, as joins and minima over the edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickroll.session import stored


def _minimum(pairs: DataFrame) -> DataFrame:
    # Partial minima come before the shuffle, so a node with many neighbours is no hot key.
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the smallest of its neighbourhood."""
    both = edges.union(edges.select("v", "u"))
    near = both.join(_minimum(both), "u").where("v > u").select(
        F.col("v").alias("u"), F.least("u", "m").alias("v"))
    return near.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = _minimum(down)
    moved = down.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(smallest.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; the root is the smallest node reachable.

    Loops and repeated edges do no harm; rows with a null end are no edges.  Each
    round writes the edges to a table, so a lost executor costs one round at most.
    """
    links = edges.where("u <> v").select("u", "v")
    now, before = stored(links, "edges"), None
    while True:
        sign = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if sign == before:
            break
        before = sign
        now = stored(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
