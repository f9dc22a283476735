"""Connected components by alternating large and small stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.session import cut_lineage

MAX_ROUNDS = 60  # doubling rounds: enough for a path of 2^60 nodes
EDGES = 1 << 20  # in a partition


def _star(edges: DataFrame, large: bool, parts: int) -> DataFrame:
    """``edges`` (u, v) with u > v, each once. Large star: the larger neighbours of u go to u's least; small: the smaller ones.

    Every exchange is written by ``parts`` tasks (twice as many in a large star), so few edges leave few shuffle files.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") > F.col("v")).coalesce(parts).distinct().coalesce(parts)


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node that links lead to."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("u") > F.col("v")).distinct()
    e = cut_lineage(e)
    seen = None
    for _ in range(MAX_ROUNDS):
        state = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        seen = state
        parts = max(1, -(-state[0] // EDGES))  # stars never add edges
        e = cut_lineage(_star(_star(e.coalesce(parts), True, parts), False, parts))
    raise RuntimeError("components did not settle")
