"""Connected components of a distributed graph by alternating large and small stars.

Every round points the neighbours of each node at the least of them; the rounds
end when the edges are stars (every node points at one that points nowhere),
which takes about log(n) rounds, none for edges that are stars already.  Edges
are written between rounds; nothing but a count reaches the driver, and a
node with many neighbours is only ever the key of a partial aggregate and the
single row of a join's other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm.stored import Scratch


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both).select("u", F.least("u", "least").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least_neighbour(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).filter("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether no node has two targets, or one and is a target itself (edges point at lesser nodes)."""
    end = lambda c, out: F.struct(F.col(c).alias("node"), F.lit(out).alias("out"), F.lit(1 - out).alias("into"))
    ends = F.array(end("u", 1), end("v", 0))
    node = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return node.filter("out > 1 or (out > 0 and into > 0)").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` (the least node of the component) for every node of an edge ``u, v`` (long, u != v)."""
    scratch = Scratch(edges.sparkSession, "components")
    edges = scratch.write(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    rounds = 0
    while not _settled(edges):
        if rounds == most_rounds:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
        large = scratch.write(_large_star(edges), "large")
        edges = scratch.write(_small_star(large), "small")
        rounds += 1
    least = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    out = scratch.write(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(least), "result")
    scratch.drop(keep=("result",))
    return out
