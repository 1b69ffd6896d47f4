"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probscope.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of the edges, the component being its smallest node.

    Rounds of two steps over edges that point from a node to a smaller one: every node and its
    larger neighbours move to its smallest neighbour, then every node and its smaller neighbours do.
    The tree flattens in a number of rounds that grows with the logarithm of the longest path. A
    node's smallest neighbour is a partial aggregate, so that a hub costs no task more than others.
    Null ends and loops are left out."""
    big, small = F.greatest(a, b), F.least(a, b)
    tree = written(edges.where(f"`{a}` != `{b}`").select(big.alias("u"), small.alias("v")).distinct(), "edges")
    while True:
        both = tree.union(tree.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        larger = tree.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v"))
        lower = larger.where("u != v").distinct()
        least = lower.groupBy("u").agg(F.min("v").alias("m"))
        moved = lower.join(least, "u")
        after = written(moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
                        .union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        sums = [t.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 999_983)).first()
                for t in (tree, after)]
        if sums[0] == sums[1]:
            break
        tree = after
    nodes = tree.groupBy("u").agg(F.min("v").alias("component"))
    roots = tree.select("v").distinct().join(nodes, F.col("v") == F.col("u"), "left_anti")
    return nodes.select(F.col("u").alias("node"), "component").union(roots.select("v", "v"))
