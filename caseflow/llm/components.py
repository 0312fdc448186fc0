"""Connected components as rounds of joins, with lineage cut in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest one: every larger neighbour, or the smaller ones and itself.

    The smallest neighbour is pre-aggregated before its shuffle and joined back, so that a node
    with very many neighbours is never gathered; the join may split its rows.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        linked = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # Every edge points from the larger to the smaller node here.
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        others = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        linked = others.unionByName(least.select("u", F.col("m").alias("v")))
    return linked.filter("u <> v").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of the undirected edges ``u, v`` (longs): root is the smallest.

    Alternates large and small stars until every node hangs on its root; the number of rounds
    grows with the logarithm of the longest chain. Each round is written to the shared folder;
    only a count and a checksum reach the driver. No edges give no rows.
    """
    pointed = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = settle(pointed.filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        state = current.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("sum")
        ).first()
        if state == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = state
        current = settle(_star(_star(current, large=True), large=False), "edges")
