"""Connected components by alternating star joins (distributed union-find).

Each round hangs every node's larger neighbours on its smallest neighbour,
then does the same for its smaller ones. Minima are aggregated before they
are shuffled and joined back, so a node with very many links is no group
that one task must hold (adaptive execution splits the joins). Each round is
a staged table; only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricekit.llm._stage import staged

MAX_ROUNDS = 60


def _stars(edges: DataFrame) -> DataFrame:
    """One large star and one small star on edges ``(hi, lo)`` with hi > lo."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u"), F.least("u", "m").alias("m"))
    large = both.join(least, "u").filter("v > u").select(
        F.col("v").alias("hi"), F.col("m").alias("lo")).filter("hi <> lo").distinct()
    low = large.groupBy("hi").agg(F.min("lo").alias("m"))
    small = large.join(low, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(
        low.select("hi", F.col("m").alias("lo")))
    return small.filter("hi <> lo").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; a component is named by its smallest node.

    Links with a null end or from a node to itself join nothing and are left
    out, repeated links count once, and no links give an empty result.
    """
    edges = staged(links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                   .filter(F.col(a).isNotNull() & F.col(b).isNotNull()).filter("hi <> lo").distinct(),
                   "edges")
    def mark(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()

    last = mark(edges)
    for _ in range(MAX_ROUNDS):
        if not last[0]:
            break
        edges = staged(_stars(edges), "edges")
        now = mark(edges)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
