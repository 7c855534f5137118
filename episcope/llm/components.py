"""Connected components of an edge table, by hooking and pointer jumping on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.llm.common import cut


def _jumped(parents: DataFrame) -> DataFrame:
    """(node, root) of a forest (node, parent) with parent < node: pointers are doubled until
    they all end at a root, so the number of steps is the logarithm of the longest chain."""
    while True:
        p = parents.select(F.col("node").alias("_n2"), F.col("parent").alias("_p2"))
        step = cut(parents.join(p, F.col("parent") == F.col("_n2"), "left")
                   .select("node", F.coalesce("_p2", "parent").alias("parent"), F.col("_p2").isNotNull().alias("moved")), "cc-jump")
        parents = step.select("node", "parent")
        if step.filter("moved").isEmpty():
            return parents.withColumnRenamed("parent", "root")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of the edges (long ids) reaches.

    Every round hooks each node to its smallest neighbour if that is smaller, follows the
    pointers to their roots and relabels the edges by root; edges inside one root go.  A
    component's smallest node is never hooked, and each round at least halves the non-root
    nodes left in the edges.  All tables stay distributed; hot nodes are combined per task.
    """
    work = cut(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b").distinct(), "cc-edges")
    labels = None
    while not work.isEmpty():
        both = work.select(F.col("a").alias("node"), F.col("b").alias("other")).union(work.select("b", "a"))
        low = both.groupBy("node").agg(F.min("other").alias("parent"))
        roots = _jumped(cut(low.filter("parent < node"), "cc-hooks"))
        if labels is None:
            nodes = both.select("node").distinct()
            labels = cut(nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("component")), "cc-labels")
        else:
            r = roots.withColumnRenamed("node", "_old")
            labels = cut(labels.join(r, F.col("component") == F.col("_old"), "left")
                         .select("node", F.coalesce("root", "component").alias("component")), "cc-labels")
        ra = roots.select(F.col("node").alias("_na"), F.col("root").alias("_ra"))
        rb = roots.select(F.col("node").alias("_nb"), F.col("root").alias("_rb"))
        work = cut(work.join(ra, F.col("a") == F.col("_na"), "left").join(rb, F.col("b") == F.col("_nb"), "left")
                   .select(F.coalesce("_ra", "a").alias("a"), F.coalesce("_rb", "b").alias("b")).filter("a <> b").distinct(), "cc-edges")
    if labels is None:
        labels = work.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
