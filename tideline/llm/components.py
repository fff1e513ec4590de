"""Connected components of a list of links, in rounds of joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as common


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) of links (a, b): component is the smallest node that can be reached.

    Every node has a parent, at first its smallest neighbour. In each round a node and its parent hook to the smallest
    grandparent among the node's neighbours, and the node to its own grandparent, as far as these are smaller; so the
    number of rounds grows with the logarithm of the longest chain. Tables are written to the shared folder each round;
    the driver sees only whether something changed. Grouping is by partial minima; links of a node with very many, and
    nodes of a very large component, are joined where they lie (`_common.joined`).
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    edges = common.written(both, "links")
    first = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"), F.count("*").alias("n"))
    first = common.written(first.select("node", "n", F.least("node", "m").alias("parent"), F.col("node").alias("old")), "parents")
    n_edges, n_nodes = edges.count(), first.count()

    def with_grandparents(parents: DataFrame) -> DataFrame:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        above = above.join(parents.groupBy("parent").agg(F.count("*").alias("children")), "parent")
        return common.written(common.joined(parents, above, ["parent"], "children", total=n_nodes), "grandparents")

    now = with_grandparents(first)
    for _ in range(rounds):
        near = common.joined(edges, now.select(F.col("node").alias("b"), "grand", "n"), ["b"], "n", total=n_edges)
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("least"))
        step = common.written(now.select("node", "n", "parent", "grand").join(near, "node"), "steps")
        hooks = step.groupBy(F.col("parent").alias("node")).agg(F.min("least").alias("hook"))
        step = step.join(hooks, "node", "left")
        step = step.select("node", "n", F.least("parent", "least", "grand", F.coalesce("hook", "parent")).alias("parent"), F.col("grand").alias("old"))
        now = with_grandparents(common.written(step, "parents"))
        if now.filter("grand <> old or grand <> parent").isEmpty():
            return now.select("node", F.col("grand").alias("component"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")
