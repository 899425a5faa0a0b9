"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import staged


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """For links (a, b): every node once, with `root`, the smallest node of its component.

    `known` may hold the roots of earlier links, which are then not needed again. Each
    round hangs every node below its smallest neighbour and contracts the links to what
    is left between the trees, so they shrink from round to round; at least the
    largest node of each component goes. All rounds work on tables, only whether links
    are left comes back.
    """
    edges = links.select("a", "b").filter("a <> b")
    roots = known
    if known is not None:
        edges = _renamed(edges, known)
    edges = staged(edges.distinct(), "links")
    while edges.limit(1).count():
        ends = edges.select(F.col("a").alias("node"), F.least("a", "b").alias("up")).union(
            edges.select(F.col("b").alias("node"), F.least("a", "b").alias("up"))
        )
        parents = staged(ends.groupBy("node").agg(F.min("up").alias("root")), "parents")
        for _ in range(2):  # of a parent its parent
            above = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            parents = staged(parents.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "parents")
        edges = staged(_renamed(edges, parents).distinct(), "links")
        roots = parents if roots is None else staged(_composed(roots, parents), "roots")
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return roots


def _renamed(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The links between the roots of their ends, each in one direction, without loops."""
    left = roots.select(F.col("node").alias("a"), F.col("root").alias("a_root"))
    right = roots.select(F.col("node").alias("b"), F.col("root").alias("b_root"))
    named = edges.join(left, "a", "left").join(right, "b", "left")
    named = named.select(F.coalesce("a_root", "a").alias("x"), F.coalesce("b_root", "b").alias("y")).filter("x <> y")
    return named.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _composed(roots: DataFrame, parents: DataFrame) -> DataFrame:
    """Roots after `parents` were hung together; nodes that are new come along."""
    above = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = roots.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    new = parents.join(roots.select("node"), "node", "left_anti").select("node", "root")
    return moved.unionByName(new)
