"""Connected components, without gathering a neighbourhood anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import cut, release

#: Links that one task contracts at most, about; more are dealt to several tasks.
LOCAL_LINKS = 1 << 20


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links (a, b), and the least node that each is linked to, directly or through others."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = code[: len(a)], code[len(a) :]
    root = np.arange(len(nodes))
    while True:
        p, q = root[x], root[y]
        apart = p != q
        if not apart.any():
            return nodes, nodes[root]
        x, y, p, q = x[apart], y[apart], p[apart], q[apart]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (root[root] != root).any():
            root = root[root]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition to links (a, b) of each node to the least one it is linked to there, itself too."""
    held = [(x.column("a").to_numpy(), x.column("b").to_numpy()) for x in batches if x.num_rows]
    if held:
        node, root = roots(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
        yield pa.record_batch([pa.array(node), pa.array(root)], names=["a", "b"])


def _done(e: DataFrame) -> bool:
    """Each node points to one other, which points to none."""
    ends = e.select(F.col("a").alias("k"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(e.select(F.col("b").alias("k"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("k").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or out = 1 and into = 1").isEmpty()


def components(edges: DataFrame, local: int = LOCAL_LINKS) -> DataFrame:
    """(node, component) of every node of edges (a, b: numbers); component is its least node.

    Tasks of about ``local`` links contract them to stars.  Where one task holds them
    all, that is the result; else stars are merged by rounds over all tasks.
    Large-star: every greater neighbour of a node is linked to the node's least
    neighbour.  Small-star: every smaller neighbour is.  Both need the least
    neighbour of a node only, an aggregate with map-side combination; the number of
    rounds grows with the logarithm of a component's diameter.  Each round is
    written to the shared folder.
    """
    e = cut(edges.where("a <> b").select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b")).distinct())
    parts = -(-e.count() // local)
    named = lambda e: e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    if parts <= 1:
        return named(e.coalesce(1).mapInArrow(_contract, "a long, b long"))
    before, e = e, cut(e.repartition(parts, F.xxhash64("a", "b")).mapInArrow(_contract, "a long, b long").where("a <> b").distinct())
    release(before)
    while not _done(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")))
        big = cut(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))
        down = big.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        before, smaller = e, cut(down.groupBy("a").agg(F.min("b").alias("m")))
        e = cut(down.join(smaller, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(smaller.select("a", F.col("m").alias("b"))).distinct())
        release(before, least, big, smaller)
    return named(e).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
