"""Connected components: within a task by numpy, across tasks by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martloom.plans.shared import materialize, shared_path


def star_edges(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) with the components of the given edges."""
    nodes, index = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = index[: len(left)], index[len(left) :]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        apart = low != high
        if not apart.any():
            break
        np.minimum.at(root, high[apart], low[apart])
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (long columns ``a, b``) that is not its component's smallest.

    Each round points neighbours above a node, then those below it, at the
    smallest neighbour; rounds grow with the logarithm of the longest chain. Every
    round is a written table. Joins meet one row per node on one side, so a node
    with many edges can be split.
    """
    spark = edges.sparkSession
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    while True:
        seen = Observation()
        watched = current.observe(
            seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")
        )
        path = shared_path(spark, "components")
        watched.write.parquet(path)
        stored = spark.read.schema("a long, b long").parquet(path)
        now = (seen.get["n"], seen.get["x"])
        if now == before or not now[0]:
            return stored.toDF("node", "root")
        before = now
        both = stored.union(stored.select("b", "a")).toDF("u", "v")
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "components")
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = small.union(below).distinct()
