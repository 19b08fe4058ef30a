"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over links (a, b); every node's neighbours are joined to the smallest of them.

    The minimum is a map-side combined aggregate and goes back by a join, so a node with very many links is
    never gathered in one place.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    found = both.join(low, "a")
    if large:
        out = found.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = found.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that has a link; ``links`` has columns a and b."""
    edges = checkpointed(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        edges = checkpointed(_star(_star(edges, large=True), large=False))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
