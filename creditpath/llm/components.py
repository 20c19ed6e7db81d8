"""Connected components of an edge table, by contracting it round after round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpath.llm.common import cut


def _stars(links: DataFrame) -> DataFrame:
    """node and root: every node points at its smallest neighbour, chains of pointers are halved until all end."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    root = cut(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")))
    while True:
        jump = root.select(F.col("node").alias("root"), F.col("root").alias("far"))
        moved = cut(root.join(jump, "root").select("node", "root", "far"))
        root = moved.select("node", F.col("far").alias("root"))
        if moved.where("far <> root").isEmpty():
            return root


def _contract(links: DataFrame, root: DataFrame) -> DataFrame:
    """The links between different roots, each once."""
    of_a = root.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    of_b = root.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    met = links.join(of_a, "a").join(of_b, "b").where("root_a <> root_b")
    return met.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the component's smallest node, for the edges ``a``, ``b`` (any order, repeats allowed).

    A round joins every node to its smallest neighbour's star and replaces the
    links by those between stars, so that nodes at least halve and a dense
    group's links vanish in the first rounds. Minima are taken before a
    shuffle, and a frequent root is only ever the many side of a join with
    unique rows. Edges from a node to itself alone give no rows.
    """
    links = cut(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    found = star = _stars(links)
    while True:
        links = cut(_contract(links, star))
        if links.isEmpty():
            return found
        star = _stars(links)
        next_ = star.select(F.col("node").alias("root"), F.col("root").alias("far"))
        found = cut(found.join(next_, "root", "left").select("node", F.coalesce("far", "root").alias("root")))
