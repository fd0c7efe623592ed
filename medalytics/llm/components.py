"""Connected components by alternating large-star and small-star rounds, all as joins and aggregates."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import remove, stage_at


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that is not the smallest of its component.

    `edges` has two long columns `a` and `b`; order, repeats and loops do not matter, rows with a null
    are ignored. A node without a row is its own component. Rounds end when the stars no longer change,
    after about log(n) of them. Every round is written to the shared folder and the one before removed.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.isnull("a").alias("n1"), F.isnull("b").alias("n2"))
    links = links.filter("NOT n1 AND NOT n2 AND a <> b").select("a", "b").distinct()
    current, path = stage_at(links, "stars")
    spark, seen = edges.sparkSession, _mark(current)
    while seen[0]:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        wide, wide_path = _star(both, "large")
        following, following_path = _star(wide, "small")
        for old in (path, wide_path):
            remove(spark, old)
        current, path, before = following, following_path, seen
        seen = _mark(current)
        if seen == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _mark(stars):
    """Row count and an order-free check value."""
    found = stars.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return found["n"], found["x"]


def _star(links, kind):
    """Join every node's links with the least node among its neighbours and itself.

    large: neighbours above the node move to that least node; small: those below it and the node do.
    The least nodes are written first, so both sides of the join are plain exchanges and a node with
    very many links is split at run time.
    """
    spark = links.sparkSession
    least = links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    stored, path = stage_at(least.select(F.col("a").alias("k"), "m"), "least")
    joined = links.join(stored, F.col("a") == F.col("k"))
    if kind == "large":
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(stored.select(F.col("k").alias("a"), F.col("m").alias("b")))
    result = stage_at(moved.filter("a <> b").distinct(), "stars")
    remove(spark, path)
    return result


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of one task as stars: (node, least node of its part) of every node that is not that least one."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[left], root[right])
        following = root.copy()
        np.minimum.at(following, root[left], least)
        np.minimum.at(following, root[right], least)
        following = following[following]
        if (following == root).all():
            break
        root = following
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]
