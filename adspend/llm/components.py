"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspend.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    links = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return links.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``u, v``; the least node names it.

    Each step is written to the shared folder. The mins are aggregated before they are
    shuffled, so a node with very many neighbours is no hot group; the number of rounds
    grows with the logarithm of the longest path. Nodes without an edge to another are
    left out: they are components of their own.
    """
    now = written(edges.select("u", "v").where("u <> v").distinct(), "edges")
    mark = None
    while (new := _mark(now)) != mark:
        mark = new
        if not mark[0]:
            break
        now = written(_small_star(_large_star(now)), "stars")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
