"""Connected components of links between long ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.common import forget, stored


def components(links: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for every node of ``links`` (columns a, b).

    Each round hangs every larger neighbour of a node on the smallest one (large star), then every smaller neighbour
    (small star). Rounds grow with the logarithm of a component's width; nothing but counts reaches the driver, and a
    hub's links are never gathered in one place: minima are pre-aggregated and joins may be split.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, mark = stored(pairs.distinct()), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("m", "x").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.union(smallest.select("u", "m")).distinct())
        forget(edges)
        edges = after
