"""Connected components of a graph given by its links, without bringing it together anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.frames import discard, saved


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``; the component is its least node.

    Large-star and small-star in turn: each node's larger neighbours, then its smaller
    ones, are linked to the least node it knows, until the links form stars. Minima are
    aggregated before the shuffle and joined back, so a node with very many links is
    split like any skewed side of a join.
    """
    edges = saved(links.select("a", "b").filter("a <> b").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = saved(large, "large-star")
        # Every link now runs from the larger node to a smaller one.
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        old, edges = edges, saved(moved.unionByName(small.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        discard(old, large)
        # In a star no node has two smaller ones, or a smaller and a larger one.
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"))
        ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("out")))
        sums = ends.groupBy("node").agg(F.sum("out").alias("smaller"), F.min("out").alias("least"))
        if not sums.filter("smaller > 1 OR (smaller = 1 AND least = 0)").agg(F.count(F.lit(1))).first()[0]:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).distinct()
