"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.llm.common import materialize

# The steps need about the logarithm of the number of nodes; more is an error.
MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node around it."""
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node it can reach.

    Rows with a null end and loops are left out. A star is an edge list, never
    a list in one row, and minima are merged before the shuffle, so a node
    with very many edges costs no task more than others. Each round is
    written to the shared folder. Without edges the result is empty.
    """
    current = materialize(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if current.isEmpty():
            break
        following = materialize(_small_star(_large_star(current)), "edges")
        same = following.count() == current.count() and following.join(current, ["u", "v"], "left_anti").isEmpty()
        current = following
        if same:
            break
    else:
        raise RuntimeError("the components did not settle")
    roots = current.groupBy(F.greatest("u", "v").alias("node")).agg(F.min(F.least("u", "v")).alias("root"))
    return roots.unionByName(current.select(F.least("u", "v").alias("node"), F.least("u", "v").alias("root")).distinct())
