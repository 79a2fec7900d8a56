"""Connected components of an edge list by alternating large-star and small-star rounds.

Every round joins and aggregates the edges on Spark and writes them to the shared folder; nothing is collected but
a count and a checksum. Minima are combined before each shuffle, and a node with very many edges is split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
    return r[0], r[1] or 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(u, v): every node but the smallest of its component, with that smallest node. Edges need u > v."""
    edges = stored(edges.distinct(), name)
    state = _state(edges)
    while state[0]:
        starred = _large_star(edges).where("u <> v").distinct()
        edges = stored(_small_star(starred).where("u <> v").distinct(), name)
        before, state = state, _state(edges)
        if before == state:
            break
    return edges
