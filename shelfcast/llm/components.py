"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import written


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is
    its smallest node. Every round hooks larger neighbours, then smaller ones,
    to the least neighbour; rounds grow with the logarithm of the longest path.
    Each round's table is written, and only its count and checksum reach the
    driver. Nodes without links don't appear; an empty table gives one."""
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "links", per_core=1)
    seen = _mark(edges)
    for _ in range(most_rounds):
        if seen[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(root, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(root.select("u", F.col("m").alias("v"))).distinct())
        edges = written(small, "links", per_core=1)
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return int(row[0]), int(row[1] or 0)
