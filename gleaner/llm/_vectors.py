"""Vectors as whole numbers, and cells of rows and queries, for the operators that compare all rows with a set of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Partitions of the shuffle of cells at most; a partition takes its cells one after the other.
PARTITIONS = 16_384


def usable(df: DataFrame) -> DataFrame:
    """The rows whose vector is there, without a null or non-finite component; floats stay floats, other numbers become doubles."""
    kind = "array<float>" if df.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    return df.withColumn("embedding", F.col("embedding").cast(kind)).where("embedding is not null and forall(embedding, x -> x is not null and abs(x) < double('infinity'))")


def by_length(lists: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and vectors (doubles) of the lists of each length."""
    size = np.diff(lists.offsets.to_numpy())
    out = {}
    for dim in np.unique(size).tolist():
        at = np.flatnonzero(size == dim)
        own = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        out[dim] = at, own.astype(np.float64).reshape(len(at), dim)
    return out


def scaled(v: np.ndarray, factor: int, room: int) -> np.ndarray:
    """floor(factor * x) of each component, as doubles that are whole; beyond the square root of 2**room / length it saturates, so that sums of products stay below 2**room."""
    most = isqrt((1 << room) // max(1, v.shape[-1]))
    with np.errstate(over="ignore"):
        return np.clip(np.floor(v * factor), -most, most)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (long) of rows of whole doubles: by doubles where all sums are proven to be below 2**53, else by longs."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def dealt(rows: DataFrame, asked: DataFrame, shards: int, blocks: int) -> DataFrame:
    """Rows and queries (column query) in cells of a shard of the rows and a block of the queries, each cell's rows one after another.

    Rows go to the cells of their shard and queries to those of their block by one
    shuffle.  Columns that only one side has are null on the other.
    """
    deal = lambda seed, count: F.pmod(F.xxhash64(F.lit(seed), "vec_id", "embedding"), F.lit(count))
    every: Callable[[int], Column] = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<long>"))
    held = rows.withColumn("shard", deal(1, shards)).withColumn("block", every(blocks)).withColumn("query", F.lit(False))
    probes = asked.withColumn("block", deal(2, blocks)).withColumn("shard", every(shards)).withColumn("query", F.lit(True))
    cells = held.unionByName(probes, allowMissingColumns=True).withColumn("cell", F.col("shard") * blocks + F.col("block")).drop("shard", "block")
    parts = min(PARTITIONS, shards * blocks)
    return cells.repartitionById(parts, F.pmod(F.col("cell"), F.lit(parts)).cast("int")).sortWithinPartitions("cell")


def cell_by_cell(answer: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that hands each cell of a sorted partition to answer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        own = None
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
            for at, to in zip(cuts[:-1], cuts[1:], strict=True):
                if at == to:
                    continue
                if kept and own != cell[at]:
                    yield from answer(pa.Table.from_batches(kept).combine_chunks())
                    kept = []
                own = cell[at]
                kept.append(batch.slice(at, to - at))
        if kept:
            yield from answer(pa.Table.from_batches(kept).combine_chunks())

    return run
