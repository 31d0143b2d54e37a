"""Connected components: inside one task with numpy, and over the cluster by random contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatspan.session import write_stage


class Forest:
    """Union-find over the numbers 0..n-1 that takes whole arrays of links; the root is the smallest member."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n, dtype=np.int64)

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        while True:
            a, b = self.root[left], self.root[right]
            apart = a != b
            if not apart.any():
                return
            left, right = left[apart], right[apart]
            low, high = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            np.minimum.at(self.root, high, low)
            while True:
                above = self.root[self.root]
                if (above == self.root).all():
                    break
                self.root = above


def connected(links: DataFrame, name: str) -> DataFrame:
    """Label every vertex of ``links`` (two long columns ``a`` and ``b``) with one vertex of its component.

    Returns (vertex, label).  Each round draws a new random order of the vertices, moves every vertex to the first one
    among itself and its neighbours, and contracts the graph; the number of vertices falls by a constant factor whatever the
    shape of the graph, so the rounds grow with the logarithm of the input.  Links are never gathered: a round is one
    pre-aggregated minimum and two joins, which adaptive execution splits where a vertex is hot.  Every round is written to
    the shared folder.  Null ends and loops are no links; an empty input gives an empty result.
    """
    moves: list[DataFrame] = []
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a != b")
    left = write_stage(links.distinct(), f"{name}-links")
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        order = lambda c: F.struct(F.xxhash64(F.lit(len(moves)), c).alias("at"), c.alias("v"))
        move = both.groupBy("a").agg(F.min(order(F.col("b"))).alias("best"))
        move = move.select("a", F.least("best", order(F.col("a")))["v"].alias("to"))
        move = write_stage(move, f"{name}-moves")
        moves.append(move)
        one = left.join(move, "a").select(F.col("to").alias("x"), "b")
        two = one.join(move.withColumnsRenamed({"a": "b", "to": "y"}), "b").where("x != y")
        left = write_stage(two.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{name}-links")
    if not moves:
        return left.select(F.col("a").alias("vertex"), F.col("b").alias("label"))
    labels = moves[0].select(F.col("a").alias("vertex"), F.col("to").alias("label"))
    for move in moves[1:]:
        # A vertex that no longer has links in a round keeps its label.
        step = move.select(F.col("a").alias("label"), "to")
        labels = labels.join(step, "label", "left").select("vertex", F.coalesce("to", "label").alias("label"))
    return write_stage(labels, f"{name}-labels")
