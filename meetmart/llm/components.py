"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meetmart.sources.scratch import materialized


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes that have an edge (a, b); the component is its smallest node.

    Each round joins the edges with the smallest neighbour of a node, first over the larger neighbours, then over
    the smaller ones, until the edges no longer change: every node then points to the smallest of its component.
    Rounds grow with the logarithm of the nodes. Both sides of a join are written tables, so the edges of a node
    with very many neighbours are split over tasks. Nothing but a checksum comes to the driver.
    """
    edges = materialized(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = None
    while before != (now := _checksum(edges)):
        before = now
        edges = _star(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        edges = _star(edges, larger=False)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Links neighbours of each node to its smallest neighbour (or itself), as edges from larger to smaller.

    `larger`: edges go both ways, and only larger neighbours are linked. Otherwise an edge goes to the smaller
    node, and the smaller neighbours and the node itself are linked.
    """
    smallest = materialized(edges.groupBy("a").agg(F.min("b").alias("m")), "smallest")
    joined = edges.join(smallest, "a")
    if larger:
        made = joined.where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            smallest.select("a", F.col("m").alias("b"))
        )
    return materialized(made.where("a != b").distinct(), "edges")


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
