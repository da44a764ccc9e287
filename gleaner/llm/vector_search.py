"""Approximate nearest neighbours by multi-index hashing.

Vectors, scaled to length 1, become binary codes: rotations learned by iterative
quantisation (one for each ``TURN`` bits, from different starts) turn the principal
axes so that taking signs loses least.  A code is split into substrings, and every
shard of the table indexes each substring.

For a Hamming radius r = m*s + a over m substrings, any code within r differs in at
most s bits in one of the first a + 1 substrings or in at most s - 1 in one of the
others (pigeonhole).  So probing each substring's index within that radius, then
checking whole codes, retrieves *every* code within r; the retrieved vectors are
reranked by exact cosines in double precision.  The radius is learned as well: the
quantile ``COVER`` of the code distances of true neighbours in a bounded sample.  A
query that finds fewer than k vectors in a shard widens its radius there.

Layout: rows are dealt to shards and queries to blocks by a hash of the whole row;
a *cell* is one shard and one block.  Rows are sent to the cells of their shard and
queries to those of their block by one shuffle, and a cell answers with k rows for
each of its queries.  A cell holds at most about ``CELL`` numbers of either side, so
it fits a task at every size of the tables, and nothing passes through the driver
but the sample.  Probing is done for blocks of ``PROBE`` queries at a time.  Of equal
vectors a cell keeps the k + 1 smallest ids, which is all that a result can show.

Defined cases: vectors that are null, empty, zero, or hold a null or a non-finite
component take no part, nor do rows without an id; a vector is compared with those of
its own length only; a repeated row counts once; of several query rows with one id
the first by value is used; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from ._spark import cut

TURN, TURNS, SUBSTRING = 64, 4, 16
SAMPLE, COVER, ROUNDS = 20_000, 0.985, 30
#: Numbers (vectors times their length) of a shard and of a block of queries at most, about.
CELL = 1 << 23
#: Rows of a shard at least, unless the table is smaller; queries that are probed for at once.
LEAST_ROWS, PROBE = 2048, 64
#: Partitions of the shuffle at most; a partition takes its cells one after the other.
PARTITIONS = 16_384
RESULT = "query_id long, vec_id long, score double"


@dataclass
class Coder:
    mean: np.ndarray
    turns: list[np.ndarray]  # each (dimension, bits): principal axes, rotated
    radius: int

    @property
    def widths(self) -> list[list[int]]:
        """Bits of each substring of each rotation's code."""
        out = []
        for t in self.turns:
            count = -(-t.shape[1] // SUBSTRING)
            out.append([t.shape[1] // count + (i < t.shape[1] % count) for i in range(count)])
        return out

    @property
    def bits(self) -> int:
        return sum(t.shape[1] for t in self.turns)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, rotations) words of at most 64 bits."""
        out = np.zeros((len(unit), len(self.turns)), np.uint64)
        for w, turn in enumerate(self.turns):
            bits = ((unit - self.mean) @ turn) > 0
            for i in range(bits.shape[1]):
                out[:, w] |= bits[:, i].astype(np.uint64) << np.uint64(i)
        return out


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of doubles scaled to length 1."""
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def ranged(v: np.ndarray) -> np.ndarray:
    """Rows of doubles, those whose greatest component is far from 1 scaled by a power of two."""
    _, power = np.frexp(np.abs(v).max(1, keepdims=True))
    return np.ldexp(v, np.where(np.abs(power) > 100, -power, 0))


def matrix(ids: pa.Array, col: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors (doubles) of the rows that take part, by the length of the vectors."""
    size = np.diff(col.offsets.to_numpy())
    there = ~col.is_null().to_numpy(zero_copy_only=False) & ~ids.is_null().to_numpy(zero_copy_only=False)
    out = {}
    for dim in np.unique(size[there & (size > 0)]).tolist():
        at = pa.array(np.flatnonzero(there & (size == dim)))
        v = col.take(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # a null component becomes NaN
        good = np.isfinite(v).all(1) & (v != 0).any(1)
        if good.any():
            out[dim] = ids.take(at).to_numpy(zero_copy_only=False).astype(np.int64)[good], v[good]
    return out


def learn_coder(v: np.ndarray, turns: int = TURNS, k: int = 5, seed: int = 3) -> Coder:
    """Rotations and radius from a sample of vectors."""
    x = unit(v)
    mean = x.mean(0)
    bits = min(TURN, x.shape[1])
    _, _, axes = np.linalg.svd(x - mean, full_matrices=False) if len(x) > bits else (0, 0, np.eye(x.shape[1]))
    y = (x - mean) @ axes[:bits].T
    coder = Coder(mean, [], bits * turns)
    for t in range(turns):
        rng = np.random.default_rng(seed + t)
        turn = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
        for _ in range(ROUNDS):
            b = np.where(y @ turn > 0, 1.0, -1.0)
            u, _, w = np.linalg.svd(b.T @ y)
            turn = (u @ w).T
        coder.turns.append(axes[:bits].T @ turn)
    if len(x) > k + 1:
        ask = np.random.default_rng(seed).choice(len(x), min(400, len(x)), replace=False)
        cos = x[ask] @ x.T
        cos[np.arange(len(ask)), ask] = -2
        near = np.argpartition(-cos, k, axis=1)[:, :k]
        codes = coder.codes(x)
        apart = np.bitwise_count(codes[ask][:, None] ^ codes[near]).sum(2)
        coder.radius = int(np.quantile(apart, COVER, method="higher"))
    return coder


class Index:
    """The substring indexes of some codes (rows, words), the bits of whose substrings are widths."""

    def __init__(self, codes: np.ndarray, widths: list[list[int]]):
        self.codes = np.ascontiguousarray(codes.T)  # a row for each word
        self.bits = sum(map(sum, widths))
        self.tables = []  # word, shift, mask, distinct keys, number of each row's key
        for word, parts in enumerate(widths):
            at = 0
            for width in parts:
                mask = np.uint64((1 << width) - 1)
                keys, number = np.unique(((self.codes[word] >> np.uint64(at)) & mask).astype(np.uint32), return_inverse=True)
                self.tables.append((word, np.uint64(at), mask, keys, number.astype(np.int32)))
                at += width

    def within(self, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of an asked code (queries, words) and a row within the Hamming radius: positions, in order."""
        seen = np.zeros((len(asked), self.codes.shape[1]), bool)
        s, a = divmod(radius, len(self.tables))
        for j, (word, shift, mask, keys, number) in enumerate(self.tables):
            reach = s if j <= a else s - 1
            if reach >= 0:
                part = ((asked[:, word] >> shift) & mask).astype(np.uint32)
                seen |= (np.bitwise_count(part[:, None] ^ keys[None, :]) <= reach)[:, number]
        if seen.mean() > 0.1:  # the same check without lists of positions
            far = np.zeros(seen.shape, np.uint16)
            for word in range(len(self.codes)):
                far += np.bitwise_count(asked[:, word, None] ^ self.codes[word])
            return np.nonzero(seen & (far <= radius))
        q, row = np.nonzero(seen)
        apart = np.zeros(len(q), np.uint16)
        for word in range(len(self.codes)):
            apart += np.bitwise_count(asked[q, word] ^ self.codes[word, row])
        near = apart <= radius
        return q[near], row[near]


def _distinct(ids: np.ndarray, v: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Without repeated rows; of equal vectors the rows with the keep smallest ids."""
    v = v + 0.0  # -0.0 equals 0.0
    raw = np.ascontiguousarray(v).view(np.dtype((np.void, v.shape[1] * 8)))[:, 0]
    _, group = np.unique(raw, return_inverse=True)
    order = np.lexsort((ids, group))
    ids, group, v = ids[order], group[order], v[order]
    new = np.ones(len(ids), bool)
    new[1:] = (group[1:] != group[:-1]) | (ids[1:] != ids[:-1])
    ids, group, v = ids[new], group[new], v[new]
    begin = np.flatnonzero(np.diff(group, prepend=-1))
    rank = np.arange(len(ids)) - np.repeat(begin, np.diff(np.append(begin, len(ids))))
    return ids[rank < keep], v[rank < keep]


def search_cell(ids: np.ndarray, v: np.ndarray, asked: np.ndarray, ask: np.ndarray, coder: Coder, k: int) -> tuple[np.ndarray, ...]:
    """For each query (asked, ask) its k nearest rows found among ids, v: query ids, ids, scores."""
    ids, v = _distinct(ids, v, k + 1)
    # A power of two scales exactly, so squares of very large and very small numbers stay in range and cosines are the same.
    v, ask = ranged(v), ranged(ask)
    index = Index(coder.codes(unit(v)), coder.widths)
    length = np.sqrt((v * v).sum(1))
    codes = coder.codes(unit(ask))
    out: tuple[list, list, list] = ([], [], [])
    for at in range(0, len(asked), PROBE):
        todo, radius = np.arange(at, min(at + PROBE, len(asked))), coder.radius
        while len(todo):
            q, row = index.within(codes[todo], radius)
            q = todo[q]
            other = ids[row] != asked[q]
            q, row = q[other], row[other]
            done = np.bincount(q, minlength=len(asked))[todo] >= k
            done |= radius >= index.bits
            ready = np.zeros(len(asked), bool)
            ready[todo[done]] = True
            q, row = q[ready[q]], row[ready[q]]
            todo, radius = todo[~done], radius + max(2, index.bits // 32)
            if not len(q):
                continue
            score = np.einsum("ij,ij->i", v[row], ask[q]) / (length[row] * np.sqrt((ask * ask).sum(1))[q])
            order = np.lexsort((ids[row], -score, q))
            q, row, score = q[order], row[order], score[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            best = rank < k
            out[0].append(asked[q[best]])
            out[1].append(ids[row[best]])
            out[2].append(score[best])
    return tuple(np.concatenate(x) if x else np.zeros(0) for x in out)


def _learn(vectors: DataFrame, sizes: dict[int, int], sample: int, k: int) -> dict[int, Coder]:
    """A coder for each length of vectors, from about sample vectors of all lengths together, 64 of each length at least."""
    each = max(64, sample // len(sizes))
    share = F.create_map(*[F.lit(x) for dim, n in sizes.items() for x in (dim, int(min(1.0, each / n) * (1 << 30)))])
    chosen = vectors.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 30)) < share[F.size("embedding")]).toArrow().combine_chunks().sort_by("vec_id")
    found = matrix(chosen.column("vec_id").combine_chunks(), chosen.column("embedding").combine_chunks()) if chosen.num_rows else {}
    out = {}
    for dim in sizes:
        if dim in found:
            ids, v = found[dim]
            v = v[np.lexsort((*v.T[::-1], ids))]
            out[dim] = learn_coder(v, k=k)
        else:  # none was drawn: the axes themselves
            out[dim] = Coder(np.zeros(dim), [np.eye(dim)[:, : min(TURN, dim)]], min(TURN, dim))
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """The k nearest rows of vectors for each row of queries (both vec_id, embedding), by cosine, without the query's own id.

    Returns query_id, rank, vec_id, score.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = lambda df: "array<float>" if df.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    number = "array<float>" if kind(vectors) == kind(queries) == "array<float>" else "array<double>"
    takes_part = "vec_id is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)"
    pick = lambda df: df.select(F.col("vec_id").cast("long"), F.col("embedding").cast(number)).where(takes_part)
    # Repeated rows go by partial aggregation, so none of them crowds a shard or the sample.
    rows, asked = cut(pick(vectors).distinct()), pick(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    sizes = {r["d"]: r["n"] for r in rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    numbers, n = sum(d * c for d, c in sizes.items()), sum(sizes.values())
    asked_numbers = asked.agg(F.sum(F.size("embedding"))).first()[0] or 0
    shards = max(-(-numbers // cell), min(2 * spark.sparkContext.defaultParallelism, -(-n // LEAST_ROWS)))
    blocks = max(1, -(-asked_numbers // cell))
    sent = spark.sparkContext.broadcast(_learn(rows, sizes, sample, k))

    deal = lambda seed, count: F.pmod(F.xxhash64(F.lit(seed), "vec_id", "embedding"), F.lit(count))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<long>"))
    held = rows.withColumn("shard", deal(1, shards)).withColumn("block", every(blocks)).withColumn("query", F.lit(False))
    probes = asked.withColumn("block", deal(2, blocks)).withColumn("shard", every(shards)).withColumn("query", F.lit(True))
    cells = held.unionByName(probes).select((F.col("shard") * blocks + F.col("block")).alias("cell"), "query", "vec_id", "embedding")
    parts = min(PARTITIONS, shards * blocks)
    dealt = cells.repartitionById(parts, F.pmod(F.col("cell"), F.lit(parts)).cast("int")).sortWithinPartitions("cell")

    def answer(table: pa.Table, coders: dict[int, Coder]) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        of = lambda t: matrix(t.column("vec_id").combine_chunks(), t.column("embedding").combine_chunks())
        asks = table.filter(table.column("query"))
        if not asks.num_rows:
            return
        held, asked = of(table.filter(pc.invert(table.column("query")))), of(asks)
        for dim, (ids, v) in asked.items():
            if dim in held:
                a, b, c = search_cell(*held[dim], ids, v, coders[dim], k)
                yield pa.record_batch([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(c, pa.float64())], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders, kept, own = sent.value, [], None
        for batch in batches:
            at = 0
            cell = batch.column("cell").to_numpy()
            for to in [*(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]:
                if to == at:
                    continue
                if kept and own != cell[at]:
                    yield from answer(pa.Table.from_batches(kept), coders)
                    kept = []
                own = cell[at]
                kept.append(batch.slice(at, to - at))
                at = to
        if kept:
            yield from answer(pa.Table.from_batches(kept), coders)

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return dealt.mapInArrow(run, RESULT).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
