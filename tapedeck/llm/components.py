"""Connected components of a graph given by its links, without a driver-side structure.

Every round each node moves to a node of its closed neighbourhood and links between the targets remain.
Even rounds move to the smallest id, which removes stars at once; odd rounds move to the smallest under
an order that is new in each such round, which shrinks any graph by a constant factor in expectation, so
the number of rounds grows with the logarithm of the longest chain. Only "is anything left" reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapedeck.llm.common import Workspace


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """(a, b) -> (node, root) for all nodes that have a link; links may repeat and lead to themselves."""
    links = links.where("a != b")
    left = work.keep(links.union(links.select("b", "a")).distinct())
    moves, done = None, 0
    while not left.isEmpty():
        order = F.lit(0) if done % 2 == 0 else F.xxhash64("b", F.lit(done))
        own = F.lit(0) if done % 2 == 0 else F.xxhash64("a", F.lit(done))
        best = left.groupBy("a").agg(F.min(F.struct(order.alias("h"), "b")).alias("to"))
        step = work.keep(best.select("a", F.least(F.struct(own.alias("h"), F.col("a").alias("b")), "to")["b"].alias("to")))
        moved = left.join(step.withColumnRenamed("to", "x"), "a").join(step.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        left = work.keep(moved.where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        if moves is None:
            moves = step.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            after = step.select(F.col("a").alias("root"), "to")
            moves = moves.join(after, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            if done % 4 == 3:
                moves = work.keep(moves)
        done += 1
    if moves is None:
        moves = left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return moves
