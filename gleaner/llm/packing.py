"""Best-fit packing of documents into training sequences, with conflicts.

A bin (a sequence of ``capacity`` units) holds at most ``per_source`` documents of a
source and one of a cluster of duplicates, so a sequence mixes sources and never repeats
itself.  Bins are kept in order of their free space; each carries a bitmap of its
sources, with ``per_source`` bits for each, and one of its clusters.  Pieces
are placed by decreasing size.  The search for a bin starts at the successor of the
piece's size, the tightest bin that is large enough, and goes on to the next wider
one until a bin's bitmaps have a free bit for the piece's source and none of its
cluster; if none is, a bin is opened.  So each piece gets the tightest compatible bin
there is.  A source of a third of all documents would need a bin for each of them if it
had a single bit: a third of a bin stays empty then, or two thirds where documents are
short (see the README).

A document larger than a bin is cut into full pieces, which have a bin of their own,
and a rest.  Sizes are bytes of UTF-8 unless a column of sizes is named (such as the
token counts of op3): a byte-level tokenizer never makes more tokens than bytes.
Clusters are equal texts unless a column of classes is named (such as those of op10).

Scale: documents are dealt by a hash to shards of about ``SHARD_ROWS`` rows, which
are packed independently, without their texts.  Rows that are equal in all that
matters here are counted by partial aggregation and dealt as copy 1, 2, ..., so
neither a hot source, nor a cluster of thousands of copies, nor one row that comes
often crowds a shard.

Defined cases: an empty (or null) text has one row with a null bin; a null source or
cluster conflicts with nothing; repeated rows are packed as often as they come, and
conflict as copies do; ties go to the smaller doc_id, then to the older bin; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from ._spark import repeated

CAPACITY, SHARD_ROWS, PER_SOURCE = 8192, 4096, 4
RESULT = "doc_id long, piece int, piece_start long, size long, bin long, slot int, bin_offset long"


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """The bin of each piece, which come by decreasing size.

    sources and clusters are bitmaps; a piece fits as long as one of its source's bits
    is free, which it takes, and all of its cluster's.
    """
    order: list[tuple[int, int]] = []  # (free space, bin), ascending
    sources_of: list[int] = []
    clusters_of: list[int] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        i = bisect_left(order, (size, -1))
        while i < len(order):
            b = order[i][1]
            if (not source or source & ~sources_of[b]) and not clusters_of[b] & cluster:
                break
            i += 1
        if i < len(order):
            free, b = order.pop(i)
        else:
            free, b = capacity, len(sources_of)
            sources_of.append(0)
            clusters_of.append(0)
        room = source & ~sources_of[b]
        sources_of[b] |= room & -room
        clusters_of[b] |= cluster
        if free > size:
            insort(order, (free - size, b))
        out.append(b)
    return out


def _bitmaps(keys: list, bits: int = 1) -> list[int]:
    """That many bits for each distinct key; none for a null, nor for a key that comes no more often than it has bits."""
    count: dict = {}
    for k in keys:
        count[k] = count.get(k, 0) + 1
    mask, at = {None: 0}, 0
    for k, n in count.items():
        if k is not None:
            mask[k] = ((1 << bits) - 1) << at if n > bits else 0
            at += bits if n > bits else 0
    return [mask[k] for k in keys]


def pack_shard(ids: list, sizes: list[int], sources: list, clusters: list, capacity: int = CAPACITY, per_source: int = 1) -> list[tuple]:
    """Rows (document's position, piece, start, size, bin, slot, offset); bin None for an empty document."""
    rests, fulls, out = [], [], []
    for i, size in enumerate(sizes):
        if not size:
            out.append((i, 0, 0, 0, None, None, None))
        full, rest = divmod(size, capacity)
        fulls += [(i, p, p * capacity, capacity) for p in range(full)]
        if rest:
            rests.append((i, full, full * capacity, rest))
    rests.sort(key=lambda x: (-x[3], ids[x[0]] is None, ids[x[0]] or 0, x[0]))
    source, cluster = _bitmaps(sources, per_source), _bitmaps(clusters)
    bins = best_fit([x[3] for x in rests], [source[x[0]] for x in rests], [cluster[x[0]] for x in rests], capacity)
    slot: dict[int, int] = {}
    begin: dict[int, int] = {}
    for x, b in zip(rests, bins, strict=True):
        out.append((*x, b, slot.get(b, 0), begin.get(b, 0)))
        slot[b], begin[b] = slot.get(b, 0) + 1, begin.get(b, 0) + x[3]
    first = len(slot)
    out += [(*x, first + i, 0, 0) for i, x in enumerate(fulls)]
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, size: str | None = None, cluster: str | None = None, shard_rows: int = SHARD_ROWS, per_source: int = PER_SOURCE) -> DataFrame:
    """A row for each piece of each row of docs (doc_id, text, source): its bin and its place there.

    size: a column of sizes; bytes of the text if none is named.  cluster: a column of
    duplicate clusters; equal texts if none is named.  per_source: documents of one source
    that a bin may hold.
    """
    ship(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(size).cast("long") if size else F.octet_length(text).cast("long"), F.lit(0)).alias("size"),
        F.col("source").cast("string").alias("source"),
        (F.xxhash64(text) if cluster is None else F.when(F.col(cluster).isNotNull(), F.xxhash64(cluster))).alias("cluster"),
    )
    each = repeated(rows.groupBy("doc_id", "size", "source", "cluster").agg(F.count("*").alias("copies")), "copies", "copy")
    shards = max(1, -(-rows.count() // shard_rows))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("size", "descending"), ("cluster", "ascending"), ("source", "ascending"), ("copy", "ascending")])
        ids, sizes, sources, clusters = (table.column(c).to_pylist() for c in ("doc_id", "size", "source", "cluster"))
        shard = table.column("shard")[0].as_py()
        done = pack_shard(ids, sizes, sources, clusters, capacity, per_source)
        at, piece, start, own, b, slot, offset = zip(*done, strict=True)
        return pa.table(
            {
                "doc_id": table.column("doc_id").take(pa.array(np.array(at))),
                "piece": pa.array(piece, pa.int32()), "piece_start": pa.array(start, pa.int64()), "size": pa.array(own, pa.int64()),
                "bin": pa.array([None if x is None else (shard << 32) | x for x in b], pa.int64()),
                "slot": pa.array(slot, pa.int32()), "bin_offset": pa.array(offset, pa.int64()),
            }
        )

    dealt = each.select("doc_id", "size", "source", "cluster", "copy", F.pmod(F.xxhash64("doc_id", "cluster", "size", "copy"), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInArrow(run, RESULT)
