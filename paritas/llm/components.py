"""Connected components of a link table, by alternating stars (large-star, small-star).

Each round writes its edges to the shared folder, so lineage and recovery stay one round
long; links never reach the driver. A hub with a third of all links is one row on the side
that holds the minima; AQE splits its rows on the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every larger (or smaller) neighbour of a node to the least of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # a is the larger end of each edge
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` (the least node of its component) of every node of ``links(a, b)`` but the roots."""
    edges = written(links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if not now["n"] or tuple(now) == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(now)
        edges = written(_star(_star(edges, True), False))
