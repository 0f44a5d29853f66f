"""Connected components of a graph given as edges, by contraction in shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.session import stage


def connect(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every end of an edge; the root is the smallest node of its component.

    ``edges`` has columns ``a`` and ``b`` of one orderable type; loops, copies and both directions of
    an edge are allowed, and no edges give no rows. Every round points each node to its smallest
    neighbor, follows the pointers to their ends and joins the edges between different ends, which at
    least halves the nodes left. Neighbors are reduced to a minimum before the shuffle, so a node with
    many edges is no hot key there; joins on it are left to the skew handling of adaptive execution.
    """
    left = stage(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    roots = None
    while not left.isEmpty():
        ends = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        parents = stage(near.select("node", F.least("node", "near").alias("root")))
        parents = _flatten(parents)
        new = parents if roots is None else _through(roots, parents)
        roots = stage(new) if roots is not None else new
        left = stage(
            _renamed(left, parents, "a", "b")
            .where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )
    if roots is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def _flatten(parents: DataFrame) -> DataFrame:
    """Follow pointers until every node points to an end; the length of chains halves each time."""
    while True:
        above = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
        moved = stage(
            parents.where("node <> root").join(above, "root").select("node", "root", "top")
        )
        if moved.where("root <> top").isEmpty():
            return parents
        ends = parents.where("node = root")
        parents = stage(ends.union(moved.select("node", F.col("top").alias("root"))))


def _through(roots: DataFrame, parents: DataFrame) -> DataFrame:
    """Roots of the earlier rounds, replaced by their own roots of this round."""
    now = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return roots.join(now, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def _renamed(edges: DataFrame, parents: DataFrame, *ends: str) -> DataFrame:
    for end in ends:
        to = parents.select(F.col("node").alias(end), F.col("root").alias("top"))
        other = [c for c in edges.columns if c != end]
        edges = edges.join(to, end).select(*other, F.col("top").alias(end))
    return edges
