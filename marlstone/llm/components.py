"""Connected components of an edge table, as DataFrame joins and aggregates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.storage import store


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of ``edges``; component is its smallest node.

    Alternating large-star and small-star rounds. The minimum of a node's
    neighbours is an aggregate with map-side combine and is joined back, so no
    task holds the neighbours of a hub; the join's hot keys can be split. Each
    round is stored in the shared folder. Edges may repeat, run either way or be
    loops; null ends are ignored. An empty table gives an empty table.
    """
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    links = store(
        edges.where(a != b)
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    loops = edges.where(a == b).select(a.alias("node"))
    seen = None
    while True:
        mark = links.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")
        ).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
        # Large star: every larger neighbour moves to the node's smallest neighbour.
        both = links.union(links.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # Small star: smaller neighbours and the node itself move to the smallest.
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(smallest, "u").where(F.col("v") != F.col("m"))
        links = store(
            moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(smallest.select("u", F.col("m").alias("v")))
            .distinct()
        )
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node")).union(loops).distinct()
    roots = roots.join(stars, "node", "left_anti")
    return stars.union(roots.select("node", F.col("node").alias("component")))


class LocalForest:
    """Vectorised union-find over the nodes 0 .. n-1 of one task."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while a.size:
            ra, rb = self.parent[a], self.parent[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not a.size:
                return
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                jumped = self.parent[self.parent]
                if np.array_equal(jumped, self.parent):
                    break
                self.parent = jumped

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(node, root) of every node that isn't its own root: at most n - 1 links."""
        nodes = np.flatnonzero(self.parent != np.arange(self.parent.size))
        return nodes, self.parent[nodes]
