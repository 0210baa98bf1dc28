"""Connected components of a distributed edge table.

A graph of at most SETTLED_EDGES different edges is settled on the driver, in one pass of
numpy over two arrays: it takes 16 bytes an edge there, and a round of the distributed steps
takes more of the driver than that, in plans, tasks and listeners. A larger graph goes by
alternating large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond"), of which nothing is collected: each round is two grouped minima and
two joins, written to the shared folder; the loop ends when a round changes no edge. Edges
of a hub sit in one key, which adaptive execution splits in the joins; the minima combine
before the shuffle. Neither step makes more edges than it reads, so the count of the first
table bounds the files of all later ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FILE_ROWS, forget, scratch, written

#: Different edges that the driver settles by itself: 3.2 MB of them.
SETTLED_EDGES = 200_000


def hook(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """parent, a forest of places in which each hangs on a smaller one or itself, with the trees
    of i and j joined pair by pair; in what returns, all hang on their roots."""
    while True:  # hook the larger root on the smaller, then shorten all paths
        p, q = parent[i], parent[j]
        apart = p != q
        if not apart.any():
            return parent
        i, j, p, q = i[apart], j[apart], p[apart], q[apart]
        np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
        while not ((up := parent[parent]) == parent).all():
            parent = up


def _settled(edges: DataFrame) -> DataFrame:
    """(node, root) of a table of few edges."""
    got = edges.select(F.col("u").cast("bigint"), F.col("v").cast("bigint")).toArrow()
    ends = np.concatenate([got.column(c).to_numpy() for c in ("u", "v")])
    nodes, at = np.unique(ends, return_inverse=True)  # sorted, so the smallest place is the smallest node
    roots = nodes[hook(np.arange(len(nodes)), *np.split(at, 2))]
    made = edges.sparkSession.createDataFrame(pa.table({"node": nodes, "root": roots}), "node bigint, root bigint")
    return made.coalesce(-(-len(nodes) // FILE_ROWS) or 1)


def components(edges: DataFrame, rounds: int = 60, settled: int = SETTLED_EDGES) -> DataFrame:
    """(node, root) for every node of edges (u, v), root the smallest node reachable.

    Self-links are kept as single nodes; repeated edges count once; no edges, no rows."""
    with scratch() as keep:
        now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        most, before = now.count(), None
        if most <= settled:
            return _settled(now)
        for _ in range(rounds):
            # large-star: every larger neighbour hangs on the smallest neighbour
            both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            large = written(large.union(now.filter("u = v")).distinct(), "edges", rows=most)
            # small-star: a node and its smaller neighbours hang on the smallest of them
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            star = large.join(low, "u")
            after = star.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
            after = written(after.distinct(), "edges", rows=most)
            seen = after.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
            forget(large)
            forget(now)
            now = after
            if tuple(seen) == before:
                break
            before = tuple(seen)
        else:
            raise RuntimeError("components did not settle")
        keep(now)
        return now.select("u", "v").union(now.select(F.col("v").alias("u"), "v")).groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
