"""Connected components of a graph of links, as tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.workspace import materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(``node``, ``root``) for every linked node; the root is the smallest node it reaches.

    Alternating large-star and small-star rounds: each node's neighbours are hung on their
    smallest one until nothing changes, in a number of rounds that grows with the logarithm
    of the graph.  Minima are combined in each task first; a node that a third of all links
    meet is an ordinary skewed join key, which the adaptive join splits.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    before = None
    while True:
        # Large star: all larger neighbours of a node hang on the smallest around it.
        both = edges.select("u", "v").union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large.where("u <> v"), "links")
        # Small star: the smaller neighbours and the node itself hang on the smallest.
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = materialize(small, "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now
