"""Connected components of a link table, without gathering any node's links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import discard, stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and root, the least node it reaches, of links (a, b: longs). Nodes without links are absent.

    Alternating large-star and small-star rounds: every node's larger, then smaller, neighbours are linked to its least
    neighbour. Each round is two aggregations with partial sums and two joins, all written, which ends their lineage and
    lets Spark deal the links of a node that has very many to several tasks.
    The number of rounds grows with the logarithm of the longest chain.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = _state(edges)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = stored(large, "large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        old, edges = edges, stored(small.distinct(), "links")
        discard(old, least, large, low)
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    raise RuntimeError(f"the components took more than {most_rounds} rounds")


def _state(edges: DataFrame) -> tuple:
    """Changes if the edges do."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u", F.lit(1)).cast("decimal(38,0)"))).first())
