"""Connected components of a distributed edge table by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.common import discard, scratch


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for all nodes of the edges but the least ones."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while not np.array_equal(root, nxt := root[root]):
            root = nxt
        if np.array_equal(before, root):
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _step(edges: DataFrame) -> DataFrame:
    """edges (u, v) with v < u. Large-star links a node's larger neighbours to its least; small-star does so with the rest."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    lower = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(lower, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node of ``edges`` (a, b: long) but the least of its component, with that least node.

    Each step is written to the shared folder, so lineage stays short; the steps grow as the logarithm of the longest chain.
    """
    now = scratch(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        after = scratch(_step(now))
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(now)
        now = after
        if tuple(mark) == seen:
            return now
        seen = tuple(mark)
