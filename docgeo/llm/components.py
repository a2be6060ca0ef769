"""Connected components of a link table, as rounds of joins and grouped minima (large star, small star)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgeo.llm.common import written


def components(links: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """``node, root``: for every node that has a link, the smallest node it can reach.

    Each round hangs the larger neighbours of a node on its smallest one, then the smaller ones. Rounds grow with the
    logarithm of a component's longest path. Only minima per node are gathered, so a node with very many links makes no
    long list; each round is written to the shared folder, so a lost executor costs one round at most.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    edges = written(links.select(u.alias("u"), v.alias("v")).filter("u <> v").distinct(), name)
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


class Forest:
    """Union-find over the positions 0..n-1, fed with arrays of pairs."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.parent[a], self.parent[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.parent[self.parent]
                if np.array_equal(up, self.parent):
                    break
                self.parent = up
