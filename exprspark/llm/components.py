"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.session import Workspace


def smallest_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = smallest_neighbour(both).select("u", F.least("u", "m").alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = smallest_neighbour(down)
    moved = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)``: each node that is not the smallest of its component, with the smallest. Input columns ``u, v``.

    Each round is written to the shared folder, so a lost executor costs one round. A table of stars, where the
    steps change nothing, ends the loop; rounds grow with the logarithm of the longest chain.
    """
    space = Workspace(edges.sparkSession, "components")
    stars = space.save(small_star(edges.filter(F.col("u") != F.col("v")).distinct()).distinct(), "0")
    mark = None
    step = 0
    while True:
        step += 1
        stars = space.save(small_star(large_star(stars).distinct()).distinct(), str(step))
        found = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == mark:
            return stars
        mark = found
