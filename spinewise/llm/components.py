"""Connected components of links between nodes (longs), in tasks and over the cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinewise.llm.common import staged


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for the links at hand; least nodes themselves are left out."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, other = place[: len(a)], place[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        x, y = parent[one], parent[other]
        apart = x != y
        if not apart.any():
            break
        one, other = one[apart], other[apart]
        np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            jumped = parent[parent]
            if (jumped == parent).all():
                break
            parent = jumped
    child = parent != np.arange(len(nodes))
    return nodes[child], nodes[parent[child]]


def _spread(frame: DataFrame, key: str = "u") -> DataFrame:
    """Dealt by another value than the join's key; with both sides straight from a shuffle Spark may split a hot node."""
    return frame.repartition(F.xxhash64(key))


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of the component of every node that has a link (a, b), roots included.

    Stars are made in turn: every node links its larger neighbours to the least of its neighbourhood, then its
    smaller ones, until each node has one smaller neighbour at most. That is a forest, and nodes then jump to
    their parents' parents. Rounds grow with the logarithm of the nodes; each is a table in the shared folder.
    Counts and least neighbours are combined before they are shuffled, and a node with very many links is only
    ever on the splittable side of a join.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staged(edges, "links")
    while edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] not in (None, 1):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.join(_spread(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        edges = staged(edges.distinct(), "links")
    while True:
        up = edges.select(F.col("u").alias("v"), F.col("v").alias("w"))
        if not edges.join(up, "v", "left_semi").limit(1).count():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        edges = staged(edges.join(_spread(up, "v"), "v", "left").select("u", F.coalesce("w", "v").alias("v")), "links")
