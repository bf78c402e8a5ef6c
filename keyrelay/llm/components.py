"""Connected components of an undirected link table by alternating star contraction.

Every round is two keyed aggregations and joins back; the links themselves stay distributed. Each round's links are
written to the shared folder, so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, spread_join


def _large_star(links: DataFrame, total: int) -> DataFrame:
    """Every neighbour greater than u is linked to the least node of u's neighbourhood (u included)."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("v").alias("n"))
    return (spread_join(both, least, "u", 2 * total, "n").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(links: DataFrame, total: int) -> DataFrame:
    """Links point from the greater node to the smaller; u and its smaller neighbours are linked to the least one."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("v").alias("n"))
    near = spread_join(down, least, "u", total, "n").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return near.union(least.select("u", "m")).toDF("a", "b").filter("a <> b").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); root is the least node of the component.

    Stops when a round changes no link, which happens exactly when the links are stars around the least nodes. The links of a node
    with very many are dealt over several tasks.
    """
    links = settle(links.select("a", "b").filter("a <> b").distinct(), name)
    before = _digest(links)
    while True:
        after = settle(_small_star(_large_star(links, before[0]), before[0]), name)
        now = _digest(after)
        # two sets of stars are equal exactly if their counts and order-free digests are
        if now == before:
            break
        links, before = after, now
    stars = after.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(after.select("b", "b").distinct())


def _digest(links: DataFrame) -> tuple:
    h = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(links.agg(F.count("a"), F.sum(h), F.bit_xor(F.xxhash64("b", "a"))).first())
