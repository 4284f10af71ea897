"""Connected components of a link table, without a driver-side graph.

Alternating star contraction: a *large star* hangs every larger neighbour of a node on the smallest one, a
*small star* does so for the smaller neighbours. The link table becomes a forest of depth one in a number of
rounds that grows with the logarithm of the graph. Every step is a grouped minimum and one join on plain
exchanges, so a node with very many neighbours is combined before the shuffle and split by AQE in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import settle


def _hang(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """For each node ``u`` of ``pairs(u, v)``: link its neighbours (and itself) to the smallest of them and itself."""
    least = settle(pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "cc-least")
    joined = pairs.join(least, "u")
    if larger_only:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.col("m").alias("v"))
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(own)
    return settle(out.where("u <> v").distinct(), "cc-links")


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of numbers, in either direction, repeats allowed, to ``(node, component)``.

    ``component`` is the smallest node that can be reached. A node without a link to another one has no row;
    links with a null end or from a node to itself are no links. An empty table gives an empty table.
    """
    ends = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links, before = settle(ends.distinct(), "cc-links"), None
    while (now := _state(links)) != before:
        before = now
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = _hang(_hang(both, larger_only=True), larger_only=False)
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
