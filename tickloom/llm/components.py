"""Connected components of a table of links, by alternating star contraction; nothing is gathered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.stacking import stack
from tickloom.sources.staging import Scratch, stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node are linked to the least of the node and its neighbours."""
    both = stack(edges, edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, are linked to the least of them.  Edges go from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return stack(others, least.select("a", F.col("m").alias("b")))


#: Links that one file of a written round holds, about.
FILE_LINKS = 200_000


def component_roots(links: DataFrame) -> DataFrame:
    """``node, root`` of every node that is not the least of its component, from links ``a, b`` of integers.

    Each round is written to the shared folder, and the one before it is deleted; it ends when the links no longer
    change, after a number of rounds that grows with the logarithm of the longest chain.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    with Scratch(links.sparkSession) as scratch:
        edges = scratch.stage(edges, "links")
        mark = None
        while True:
            now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
            if now == mark or not now[0]:
                return stage(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).coalesce(1 + now[0] // FILE_LINKS), "roots")
            mark, files = now, 1 + now[0] // FILE_LINKS
            larger = scratch.stage(_large_star(edges).where("a <> b").distinct().coalesce(files), "links")
            scratch.drop(edges)
            edges = scratch.stage(_small_star(larger).where("a <> b").distinct().coalesce(files), "links")
            scratch.drop(larger)
