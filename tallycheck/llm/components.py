"""Connected components of a graph given as edges, by hooking and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _roots(parents: DataFrame) -> DataFrame:
    """Follow ``parent`` (never above ``node``) to the end by pointer doubling."""
    while True:
        up = parents.select(F.col("node").alias("_node"), F.col("parent").alias("_up"))
        jumped = parents.join(up, parents["parent"] == up["_node"]).select("node", F.col("_up").alias("parent"), (F.col("_up") != F.col("parent")).alias("moved"))
        jumped = written(jumped, "component-jump")
        moved = jumped.filter("moved").isEmpty()
        parents = jumped.select("node", "parent")
        if moved:
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long); root is the component's least node.

    Each round hooks every node to its least neighbour if that is smaller, follows the hooks to their
    ends and contracts the edges; a round at least halves the nodes left, so rounds are logarithmic. Rounds are written to
    the shared folder. A node with very many edges is merged before the shuffle (a least value) and joined by splittable joins.
    """
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "component-edges")
    found: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        roots = _roots(written(hooks.select("node", F.least("node", "least").alias("parent")), "component-hooks"))
        if found is None:
            found = roots.withColumnRenamed("parent", "root")
        else:
            later = roots.select(F.col("node").alias("_node"), F.col("parent").alias("_root"))
            found = written(found.join(later, found["root"] == later["_node"], "left").select("node", F.coalesce("_root", "root").alias("root")), "components")
        of_a = roots.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        of_b = roots.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        contracted = edges.join(of_a, "a").join(of_b, "b").filter("ra <> rb")
        edges = written(contracted.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "component-edges")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
