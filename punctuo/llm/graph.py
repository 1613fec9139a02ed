"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuo.operators.util import checkpoint_table


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is one node of its component.

    Contraction: every node points at its smallest neighbour (or itself), edges
    are redrawn between the targets, until none is left; then the pointers are
    followed. Node ids should be hashes: then a round leaves about a third of
    the nodes, whatever the shape. Nothing is collected; a hub's neighbours are
    reduced with map-side minima and its edges joined as AQE splits them."""
    edges = checkpoint_table(edges.select("a", "b").filter("a <> b").distinct())
    steps = []
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = checkpoint_table(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")))
        steps.append(step)
        moved = edges.join(step, "a").select(F.col("to").alias("x"), "b").join(step.select(F.col("a").alias("b"), "to"), "b")
        edges = checkpoint_table(moved.select(F.col("x").alias("a"), F.col("to").alias("b")).filter("a <> b").distinct())
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = steps[0].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for step in steps[1:]:
        out = out.join(step.withColumnRenamed("a", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return checkpoint_table(out)


def joined(found: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) after more ``edges`` (a, b: long): components of the graph whose components are ``found``.

    Only edges between different roots are left to contract."""
    for end in ("a", "b"):
        at = found.select(F.col("node").alias(end), F.col("root").alias("at"))
        edges = edges.join(at, end, "left").withColumn(end, F.coalesce("at", end)).drop("at")
    more = components(edges)
    if more.isEmpty():
        return found
    moved = found.join(more.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return checkpoint_table(moved.unionByName(more.join(found, "node", "left_anti")))
