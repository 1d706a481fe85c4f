"""Connected components of a graph given as edges, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def _ordered(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    )


def _jump(links: DataFrame) -> DataFrame:
    """Every node points to its parent's parent."""
    above = links.select(F.col("node").alias("_n"), F.col("parent").alias("_p"))
    return links.join(above, links.parent == above._n, "left").select("node", F.coalesce("_p", "parent").alias("parent"))


def _stars(links: DataFrame) -> DataFrame:
    """Links of any depth to links to roots; the depth falls to a quarter with each written table."""
    while True:
        inner = links.select(F.col("node").alias("parent")).distinct()
        if links.join(inner, "parent", "left_semi").isEmpty():
            return links
        links = materialize(_jump(_jump(links)), "jump")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the same within a component.

    Each round every node hooks to its smallest smaller neighbour, chains are shortened to stars, and the edges
    are relabelled by the stars' centres. Nodes that are hash values get short chains. Nothing is collected; the
    rounds are cut by tables in the shared scratch folder, so a lost executor costs a reread.
    """
    edges = materialize(_ordered(edges), "edges")
    rounds: list[DataFrame] = []
    everyone = edges
    while not edges.isEmpty():
        hooks = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        links = _stars(materialize(hooks, "hooks"))
        rounds.append(links)
        to_a = links.select(F.col("node").alias("a"), F.col("parent").alias("_pa"))
        to_b = links.select(F.col("node").alias("b"), F.col("parent").alias("_pb"))
        moved = edges.join(to_a, "a", "left").join(to_b, "b", "left")
        edges = materialize(
            _ordered(moved.select(F.coalesce("_pa", "a").alias("a"), F.coalesce("_pb", "b").alias("b"))), "edges"
        )
    nodes = everyone.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = nodes.select("node", F.col("node").alias("root"))
    for links in rounds:
        above = links.select(F.col("node").alias("_n"), F.col("parent").alias("_p"))
        roots = roots.join(above, roots.root == above._n, "left").select("node", F.coalesce("_p", "root").alias("root"))
    return materialize(roots, "roots")
