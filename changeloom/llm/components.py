"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.operators.scale import stored_alone as stored


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of links (a, b): the smallest node that links reach.

    Alternates two steps until nothing changes. Large star: a node's larger neighbours point to its smallest one.
    Small star: a node and its smaller neighbours point to the smallest of these. Minima are aggregated before they
    are joined back, so a node with very many links is no group of its own; each round is a stored table. Rounds grow
    with the logarithm of the longest path.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Larger neighbours move; links to smaller ones are kept by the other end.
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        edges = stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("links did not settle")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
