"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.tables import keep


def _smallest(pairs: DataFrame) -> DataFrame:
    """Each pair (u, v) with the smallest of u and all its partners."""
    low = pairs.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    return pairs.join(low, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger partners of each node are tied to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller partners are tied to the smallest of them."""
    rows = _smallest(edges)
    return rows.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id in ``edges``; the component is the smallest id reachable.

    Each round is written, so a lost executor costs one round. Pairs of an id with itself, repeated
    pairs and pairs with a null are left out. A node with very many partners is only ever combined
    (its smallest partner) and joined, never gathered.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    pairs, mark = keep(pairs, "edges"), None
    while True:
        found = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (found.n, found.x) == mark:
            return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        mark = (found.n, found.x)
        pairs = keep(_small_star(_large_star(pairs)), "edges")
