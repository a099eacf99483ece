"""Connected components of an edge table, by alternating star contractions.

Every round points each node's larger neighbours at its smallest one (large
star), then its smaller ones (small star), and ends when nothing changes; the
edges are then stars around the smallest node of each component. The rounds are
logarithmic in practice. The edges never leave the executors; each round is
written to the shared folder, which cuts its lineage. The minimum per node is
aggregated before the shuffle; a hub's edges are joined, so a hot hub's
partition can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import scratch_table


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long, null-free); component: its smallest node.

    Loops and repeated edges are allowed; no edges give no rows.
    """
    # Larger end first.
    edges = scratch_table(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _summary(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        lowest = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("m"))
        # Large star: the larger neighbours v of n point at m.
        pointed = both.join(lowest, F.col("a") == F.col("n")).filter("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch_table(pointed, "large")
        # Small star: of a node's smaller neighbours, all and the node itself point at the smallest.
        smallest = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        rest = large.join(smallest, F.col("a") == F.col("n")).filter("b <> m").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        edges = scratch_table(rest.union(smallest.select("n", "m")).distinct(), "small")
        after = _summary(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select("b", "b").distinct())
