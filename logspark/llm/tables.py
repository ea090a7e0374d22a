"""Intermediate tables in the shared folder, size-checked joins and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logspark.session import delete_table, shared_folder, written

#: Ids a join may broadcast (8 bytes each); above it the join is by shuffle.
BROADCAST_IDS = 1_000_000

__all__ = ["components", "delete_table", "shared_folder", "small", "written"]


def small(df: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """df with a broadcast hint if it has at most limit rows, else as it is (Spark then shuffles, and splits skewed keys)."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, component) of each node: the smallest id it can reach over edges (a, b).

    Each round ties every node to its smallest smaller neighbour, shortens these ties, and moves labels and edges to
    the nodes tied to. Edges inside what has become one node are dropped, so that the edges left shrink quickly; an
    edge is read in few rounds. Rounds are written to the shared folder; nothing is collected.
    """
    labels = nodes.select("id", F.col("id").alias("component"))
    left = written(_ordered(edges.select("a", "b")), "edges")
    while not left.isEmpty():
        ties = written(left.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("up")), "ties")
        for _ in range(2):
            above = ties.select(F.col("id").alias("up"), F.col("up").alias("above"))
            ties = ties.join(above, "up", "left").select("id", F.coalesce("above", "up").alias("up"))
        ties = written(ties, "ties")
        to = lambda c: ties.select(F.col("id").alias(c), F.col("up").alias(f"{c}_up"))
        moved = left.join(to("a"), "a", "left").join(to("b"), "b", "left").select(F.coalesce("a_up", "a").alias("a"), F.coalesce("b_up", "b").alias("b"))
        left = written(_ordered(moved), "edges")
        labels = written(labels.join(to("component"), "component", "left").select("id", F.coalesce("component_up", "component").alias("component")), "labels")
    return labels


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges with a < b."""
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
