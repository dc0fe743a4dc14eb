"""Connected components of a large graph, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.sources.session import saved


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node on an edge; nodes have the same root if and only if a path joins them.

    edges: a, b (long). In a round every node goes over to the node of its closed neighbourhood that comes first
    in that round's random order, and edges are drawn anew between where their ends have gone. A share of the
    nodes vanishes in every round, chains included, so the rounds grow with the logarithm of their number.
    Each round is written, so a lost executor costs no earlier round.
    """
    left = saved(edges.select("a", "b").where("a <> b").distinct())
    moves: list[DataFrame] = []
    while not left.isEmpty():
        order = len(moves)
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = F.min(F.struct(F.xxhash64("b", F.lit(order)).alias("rank"), F.col("b").alias("id")))
        own = F.struct(F.xxhash64("a", F.lit(order)).alias("rank"), F.col("a").alias("id"))
        moved = both.groupBy("a").agg(best.alias("_best"))
        step = saved(moved.select(F.col("a").alias("node"), F.least(F.col("_best"), own)["id"].alias("to")))
        moves.append(step)
        left = saved(
            left.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .distinct()
        )
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[0].select("node", F.col("to").alias("root"))
    for step in moves[1:]:
        found = found.join(step.select(F.col("node").alias("root"), "to"), "root", "left").select(
            "node", F.coalesce("to", "root").alias("root")
        )
    return saved(found)
