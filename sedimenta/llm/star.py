"""Star clustering of a similarity graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import cut


def star_clusters(edges: DataFrame, priority: DataFrame) -> DataFrame:
    """node, center for every node with an edge.

    ``edges`` has a, b, sim (each pair once, either way), ``priority`` node and
    the struct ``prio``, which must differ between nodes. Centers are those the
    greedy pass over nodes of falling priority would mark: a node none of whose
    neighbours is a center before it. All nodes that outrank their undecided
    neighbours are decided at once, so a round costs one aggregation and the
    result is that of the sequential pass. A satellite of several stars goes to
    the most similar center, then the one of higher priority.
    """
    p = priority.select("node", "prio")
    both = edges.select("a", "b", "sim").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    both = both.where(F.col("a") != F.col("b")).groupBy("a", "b").agg(F.max("sim").alias("sim"))
    both = both.join(p.select(F.col("node").alias("a"), F.col("prio").alias("pa")), "a")
    graph = cut(both.join(p.select(F.col("node").alias("b"), F.col("prio").alias("pb")), "b"))
    left = graph
    found: DataFrame | None = None
    while not left.isEmpty():
        centers = left.groupBy("a").agg(F.max("pb").alias("pb"), F.first("pa").alias("pa")).where(F.col("pa") > F.col("pb")).select(F.col("a").alias("center"))
        centers = cut(centers)
        found = centers if found is None else found.unionByName(centers)
        done = cut(
            left.join(centers, F.col("b") == F.col("center"), "left_semi").select(F.col("a").alias("gone")).unionByName(centers.select(F.col("center").alias("gone"))).distinct()
        )
        left = cut(
            left.join(done, F.col("a") == F.col("gone"), "left_anti").join(done, F.col("b") == F.col("gone"), "left_anti")
        )
    if found is None:
        return graph.select(F.col("a").alias("node"), F.col("b").alias("center"))
    # A node whose neighbours were all decided by others is a center too; it has no edge left to say so.
    touched = graph.join(found, F.col("b") == F.col("center"), "left_semi").select(F.col("a").alias("node")).unionByName(found.select(F.col("center").alias("node")))
    rest = graph.select(F.col("a").alias("node")).distinct().join(touched.distinct(), "node", "left_anti")
    centers = cut(found.unionByName(rest.select(F.col("node").alias("center"))))
    linked = (
        graph.join(centers, F.col("b") == F.col("center"), "left_semi")
        .join(centers, F.col("a") == F.col("center"), "left_anti")
        .groupBy("a")
        .agg(F.max(F.struct("sim", "pb", "b")).alias("m"))
        .select(F.col("a").alias("node"), F.col("m.b").alias("center"))
    )
    return linked.unionByName(centers.select(F.col("center").alias("node"), "center"))
