"""Connected components of a table of links by alternating star operations, each a grouped minimum and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """(node, root) for every node with a link; the root is the smallest node of the component.

    Each round's edges are written down. A star is stable, so the end shows as two rounds with equal edges.
    """
    high, low = F.greatest(a, b), F.least(a, b)
    edges = settle(links.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(row) == mark or not row[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = tuple(row)
        edges = settle(_small(_large(edges)))
    raise RuntimeError(f"links did not settle in {rounds} rounds")
