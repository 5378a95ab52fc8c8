"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import keep


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b); component is the smallest node.

    Large-star and small-star steps in turn. Each step keeps a node's smallest neighbour by
    a pre-aggregated minimum, never a neighbour list, and ends as a written table. Every node
    but the component's own is in the result; links from a node to itself don't count.
    """
    links = links.where("a <> b")
    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        now = edges.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = keep(small.union(least).distinct())
