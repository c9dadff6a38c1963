"""Connected components of an undirected graph kept in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfunnel.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; nodes of a component share a root.

    Rounds of contraction: every node goes over to its least neighbour if that is less than
    itself, edges are rewritten to what their ends became, and those inside one node vanish. With
    nodes numbered at random, as hashes are, at least half the nodes go in a round. Each round is
    written out, so a lost executor repeats one round at most and no plan grows with the rounds.
    """
    left = saved(_normal(edges), "edges")
    roots = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")).withColumnRenamed("a", "node")
        step = saved(step, "contraction")
        if roots is None:
            roots = step.withColumnRenamed("to", "root")
        else:
            moved = roots.join(step.withColumnRenamed("node", "root"), "root", "left")
            roots = saved(moved.select("node", F.coalesce("to", "root").alias("root")), "roots")
        left = left.join(step.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
        left = left.join(step.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
        left = saved(_normal(left.select(F.col("ta").alias("a"), F.col("tb").alias("b"))), "edges")
    if roots is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def _normal(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ends.filter("a < b").distinct()
