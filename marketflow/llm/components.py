"""Connected components of large graphs by alternating stars, and of small ones in memory."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.session import stored


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable from each of ``n`` nodes, for links a-b."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        differ = low != high
        if not differ.any():
            break
        a, b, low, high = a[differ], b[differ], low[differ], high[differ]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node reachable.

    Large-star and small-star steps by turns, each two aggregates and a join on equal keys, until a
    round changes nothing; the number of rounds grows with the logarithm of the longest path.  Each
    round's links are written to the shared folder, which cuts the lineage.  Links of a node to
    itself and nulls are ignored; a node without other links is not returned.
    """
    edges = stored(_oriented(links.select(F.col("a").cast("long"), F.col("b").cast("long"))), "links")
    before = _fingerprint(edges)
    if before[0] == 0:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(rounds):
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _fingerprint(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _oriented(edges: DataFrame) -> DataFrame:
    """Each link once, from its larger node ``a`` to its smaller ``b``."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node are linked to its smallest neighbour (or to itself)."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    far = edges.select(F.col("b").alias("a"), F.col("a").alias("v"))  # v is larger than a
    return _oriented(far.join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, are linked to its smallest neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(moved.unionAll(least.select("a", F.col("m").alias("b"))))
