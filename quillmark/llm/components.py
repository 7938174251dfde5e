"""Connected components of a graph whose edges and labels stay distributed."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import written


def _joined(left: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """left with `column` replaced by its parent, where it has one."""
    p = parents.select(F.col("node").alias(column), F.col("parent").alias("_p"))
    return left.join(p, column, "left").withColumn(column, F.coalesce("_p", column)).drop("_p")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges: (a long, b long). Returns (node, root): each node that has an edge, and the component's mark.

    Each round points every node at its smallest neighbour, follows the pointers twice, and
    puts the pointed-at nodes in the edges' places; edges within a node go. The rounds end
    when no edge is left, after about the logarithm of the longest path. All joins read
    written tables, so a node with very many edges is a skewed partition, which Spark splits.
    """
    left = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        if len(rounds) == max_rounds:
            raise RuntimeError("connected components did not converge")
        both = left.union(left.select("b", "a"))
        parents = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("parent")), "parents")
        for _ in range(2):
            parents = _joined(parents, "parent", parents)
        parents = written(parents, "parents")
        rounds.append(parents)
        moved = _joined(_joined(left, "a", parents), "b", parents).where("a <> b")
        left = written(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[-1]
    for parents in reversed(rounds[:-1]):
        found = written(_joined(parents, "parent", found), "roots")
    return found.select("node", F.col("parent").alias("root"))


def smallest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component."""
    mark = np.arange(n)
    while True:
        low = np.minimum(mark[u], mark[v])
        new = mark.copy()
        np.minimum.at(new, mark[u], low)
        np.minimum.at(new, mark[v], low)
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == mark).all():
            return mark
        mark = new
