"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of star contraction. Large: each vertex hands the vertices above it
    to its smallest neighbour. Small: those below it, and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    seen = both if large else edges   # edges are stored with a > b
    low = seen.groupBy("a").agg(F.min("b").alias("m"))
    low = low.select("a", F.least("a", "m").alias("m"))
    if large:
        moved = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = (edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))))
    return moved.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, root) for every vertex of ``edges`` (columns a, b) that has a smaller one
    in its component; ``root`` is the smallest vertex reachable. Repeated edges and
    loops are allowed, null ends are not.

    Star contraction: a vertex never gathers its neighbours, only their minimum, so
    a hub with any number of links is summed before the shuffle and joined in parts.
    It ends after about log2 of the longest path, when every edge leads to a root.
    """
    edges = stored(edges.where("a <> b")
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "edges")
    while True:
        edges = stored(_star(stored(_star(edges, True), "large"), False), "small")
        roots = edges.select(F.col("b").alias("a")).distinct()
        more = edges.join(roots, "a", "left_semi").limit(1).count()
        twice = more or edges.groupBy("a").count().where("count > 1").limit(1).count()
        if not twice:
            return edges.select("a", F.col("b").alias("root"))
