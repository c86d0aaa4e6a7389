"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import landed


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    found = both.join(least, "u").where(F.col("v") > F.col("u"))
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where(F.col("v") != F.col("m"))
    tied = others.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that can be reached, for every node of an edge.

    ``edges`` has two columns of whole numbers; nulls, loops and repeated edges do no harm. Large
    and small stars take turns (logarithmically many rounds) until every node is tied to the least
    of its component alone. Each round is one landed table; minima are combined before the
    shuffle, so a hub with most of the edges is met by one row per task.
    """
    u, v = (F.col(c) for c in edges.columns[:2])
    now = edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    now, before = landed(now.distinct(), "edges"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = landed(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
