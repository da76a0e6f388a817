"""Connected components of links between integers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import fitted, staged


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable by ``links`` (a, b), for each node that has a link.

    Every node points to its smallest neighbour, chains of pointers are halved until all point to a local minimum, and
    the links are redrawn between those minima, which leaves at most half as many nodes. Each step is written, so
    its joins read plain tables, whose hot keys adaptive execution splits.
    """
    left = staged(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    rounds = []
    while count := left.count():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointers = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        pointers = staged(fitted(pointers.select("node", F.least("node", "root").alias("root")), 2 * count), "pointers")
        while True:
            above = pointers.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = pointers.join(above, "root").select("node", F.col("above").alias("root"), (F.col("above") < F.col("root")).alias("moved"))
            jumped = staged(fitted(jumped, 2 * count), "pointers")
            pointers = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        rounds.append(pointers)
        ends = left
        for end in ("a", "b"):
            ends = ends.join(pointers.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end)
        ends = ends.filter("a_root <> b_root")
        left = ends.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct()
        left = staged(fitted(left, count), "links")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    result, count = rounds[0], rounds[0].count()
    for pointers in rounds[1:]:
        further = pointers.select(F.col("node").alias("root"), F.col("root").alias("further"))
        result = result.join(further, "root", "left").select("node", F.coalesce("further", "root").alias("root"))
    return staged(fitted(result, count), "components") if len(rounds) > 1 else result


def local_roots(nodes: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of 0 .. nodes - 1, within one task."""
    root = np.arange(nodes)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        moved = low < high
        if not moved.any():
            return root
        a, b = a[moved], b[moved]
        np.minimum.at(root, high[moved], low[moved])
        while not np.array_equal(above := root[root], root):
            root = above
