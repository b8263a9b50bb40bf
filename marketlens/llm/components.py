"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum, combined before the shuffle, and a join of
the edges to those minima. Few minima are broadcast (their number is bounded
by the counted edges); many are written first, so both sides of the join are
plain shuffles and adaptive execution can split a hub's edges. The number of
rounds grows with the logarithm of a component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.tables import FEW, written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.min("u"), F.max("v")).first())


def _minima(least: DataFrame, edges: int) -> DataFrame:
    return F.broadcast(least) if 2 * edges <= FEW else written(least, "star")


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _minima(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), n)
    return both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    own = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = _minima(own, n)
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union((own if 2 * n <= FEW else least).select("u", F.col("m").alias("v"))).distinct()


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge to another; component: the smallest node reachable.

    Null ends and loops are ignored; no edges give an empty result.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pairs = written(pairs, "edges")
    mark = _mark(pairs)
    while mark[0]:
        pairs = written(_small_star(written(_large_star(pairs, mark[0]), "large"), mark[0]), "small")
        before, mark = mark, _mark(pairs)
        if mark == before:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select("v", "v").distinct())
