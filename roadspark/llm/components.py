"""Connected components of a table of edges, by stars, without collecting any of it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspark.runtime import written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node of the component) for every node on an edge.

    ``edges`` has long columns ``a`` and ``b``. Rounds of large and small stars
    hang neighbours on the smallest one until a round changes nothing. Each
    round is written to the shared folder. Only counts reach the driver, sums are
    partial before they are shuffled, and joins are on one row per node.
    """
    links = written(_downward(edges), "links")
    before = None
    while True:
        links = written(_round(links), "links")
        state = links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.withColumn("root", F.col("node"))
    )


def _downward(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node ``a`` to the smaller ``b``."""
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    return edges.where("a <> b").select(a, b).distinct()


def _round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step; ``a > b`` holds before and after."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    hung = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of ``a[i]`` and ``b[i]`` in ``root``, in place; every entry then names its smallest member."""
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up
