"""Connected components as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.llm.tables import keep


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("u", "m").toDF("a", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of ``edges`` (columns ``a`` and ``b``).

    Alternates the two star operations, each two shuffles over the edges
    that are left, until nothing changes; rounds grow with the logarithm of
    the longest chain. Every round is kept, so a lost executor costs no
    earlier one. Loops and repeated edges do no harm; no edges give no rows.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    now = keep(edges.where("a != b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(mark) == seen or not mark[0]:
            break
        seen = tuple(mark)
        now = keep(_small_star(_large_star(now)), "edges")
    return nodes.join(now.toDF("node", "root"), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
