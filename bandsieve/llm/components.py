"""Connected components of a table of links, by min-label rounds in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandsieve.llm._shared import materialize


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) for every node of links (a, b).

    Large-star and small-star steps alternate until nothing changes: rounds grow with the logarithm of a component's size, and a
    node's links are only ever reduced to a minimum, never gathered."""
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        # Large star: every larger neighbour of u gets u's smallest neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: every smaller neighbour of u, and u, get u's smallest neighbour.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()
