"""Connected components of a graph given as edges, by alternating star contractions.

Every step is a join or a grouped minimum; nothing about the graph comes to the driver except one
checksum a round. Each round is written to shared scratch, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.frames import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    links = down.join(least, "u")
    return links.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
        least.select("u", F.col("m").alias("v"))
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; root is the smallest node of the component."""
    edges = staged(edges.select("u", "v").where("u <> v").distinct(), "edges")
    before = None
    while True:
        edges = staged(_small_star(_large_star(edges)).distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
