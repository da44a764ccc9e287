"""Hard-negative mining by a full sort of scores for each anchor.

Vectors become whole numbers, floor(scale * x); a score is an inner product of these, a
long.  For an anchor all rows are sorted by score, the greatest first, then by id.  Its
*positives* are the first rows of its own label.  For each positive a binary search finds
where the scores fall to the positive's (the upper limit), and the first k rows of other
labels are read from there on, as long as they are not below the lower limit.

Layout: rows are dealt to shards and anchors to blocks, and every cell (a shard and a
block) sorts what it holds, so no task holds all rows and nothing passes through the
driver.  Limits come from positives of all shards; so the cells are gone through twice,
first for positives, then for negatives, and each time a cell gives as many rows as the
result may have.  Recomputing scores costs less than keeping all of them.

Defined cases: rows without an id, a label or a vector, or whose vector holds a null or a
non-finite component, take no part; a vector is compared with those of its own length
only, and an empty one scores 0; a repeated row counts once; rows that differ but share an id are different
rows, never partners of an anchor with that id; of several anchors with one id the first by
label and vector is used; a scaled component saturates where the square root of
2**62 / length is exceeded, so that a score is always a long; an anchor without positives, and a
positive without negatives between the limits, give no rows (below 0 the lower limit is
above the upper one); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from ._spark import cut
from ._vectors import by_length, cell_by_cell, dealt, products, scaled, usable

#: Numbers (vectors times their length) of a shard and of a block of anchors at most, about.
CELL = 1 << 22
#: Rows of a shard at least, unless the table is smaller; anchors whose scores are held at once.
LEAST_ROWS, STEP = 2048, 64
#: So that every sum of products is a long.
ROOM = 62
POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 5, 80, 100, 256
_MET = "anchor_id long, vec_id long, score long"
_MINED = "anchor_id long, positive_id long, place int, positive_score long, negative_id long, negative_score long"


def ranked(scores: np.ndarray) -> np.ndarray:
    """The places of scores of rows in the order of their ids: the greatest first, ties by id."""
    return np.argsort(-scores, kind="stable")


def limits(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the greatest n with low * score <= 100 * n <= high * score."""
    return -(-low * score // 100), high * score // 100


def between(scores: np.ndarray, least: int, most: int, k: int) -> range:
    """The first k places of descending scores that are at most ``most`` and at least ``least``."""
    falling, edge = -scores, (1 << ROOM) + 1  # no score is beyond
    clipped = lambda x: max(-edge, min(edge, x))
    begin = int(np.searchsorted(falling, -clipped(most), "left"))
    end = int(np.searchsorted(falling, -clipped(least), "right"))
    return range(begin, min(begin + k, end))


def _sides(cell: pa.Table, scale: int) -> Iterator[tuple[dict, dict]]:
    """Rows and anchors of a cell, for each length: ids, label numbers and scaled vectors, by id."""
    label = cell.column("label").combine_chunks().dictionary_encode()
    label = (label.combine_chunks() if isinstance(label, pa.ChunkedArray) else label).indices.to_numpy(zero_copy_only=False)
    cell = cell.append_column("number", pa.array(label.astype(np.int64)))
    query = cell.column("query")
    both = []
    for side in (cell.filter(pc.invert(query)), cell.filter(query)):
        side = side.combine_chunks().sort_by("vec_id").combine_chunks()
        lists = side.column("embedding").combine_chunks() if side.num_rows else None
        found = {}
        for dim, (at, v) in (by_length(lists) if lists is not None else {}).items():
            own = side.take(pa.array(at))
            found[dim] = {"id": own.column("vec_id").to_numpy(), "label": own.column("number").to_numpy(), "v": scaled(v, scale, ROOM), "rows": own}
        both.append(found)
    rows, asked = both
    for dim in asked.keys() & rows.keys():
        yield rows[dim], asked[dim]


def _scores(rows: dict, asked: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor its place, the order of the rows (its own left out) and their scores in that order."""
    for lo in range(0, len(asked["id"]), STEP):
        found = products(asked["v"][lo : lo + STEP], rows["v"])
        for i, scores in enumerate(found, lo):
            order = ranked(scores)
            order = order[rows["id"][order] != asked["id"][i]]
            yield i, order, scores[order]


def mine(rows: DataFrame, asked: DataFrame, shards: int, blocks: int, positives: int, k: int, low: int, high: int, scale: int) -> DataFrame:
    """Positives and negatives of anchors (vec_id, embedding, label) among rows (the same)."""

    def nearest(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        for own, ask in _sides(cell, scale):
            for i, order, scores in _scores(own, ask):
                at = np.flatnonzero(own["label"][order] == ask["label"][i])[:positives]
                out[0].append(np.full(len(at), ask["id"][i]))
                out[1].append(own["id"][order[at]])
                out[2].append(scores[at])
        if out[0]:
            yield pa.record_batch([pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["anchor_id", "vec_id", "score"])

    def mined(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        out: tuple[list, ...] = ([], [], [], [], [], [])
        for own, ask in _sides(cell, scale):
            wanted = ask["rows"].column("positives").to_pylist()
            for i, order, scores in _scores(own, ask):
                other = own["label"][order] != ask["label"][i]
                order, scores = order[other], scores[other]
                for p in wanted[i] or ():
                    at = between(scores, *limits(p["score"], low, high), k)
                    for out_column, values in zip(out, ([int(ask["id"][i])] * len(at), [p["vec_id"]] * len(at), [p["place"]] * len(at), [p["score"]] * len(at), own["id"][order[at.start : at.stop]], scores[at.start : at.stop]), strict=True):
                        out_column.extend(values)
        if out[0]:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["anchor_id", "positive_id", "place", "positive_score", "negative_id", "negative_score"])

    met = dealt(rows, asked, shards, blocks).mapInArrow(cell_by_cell(nearest), _MET)
    # Each cell gives the first of its own; of these the first of all are kept.
    first = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    best = met.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    lists = cut(best.groupBy("anchor_id").agg(F.collect_list(F.struct("place", "vec_id", "score")).alias("positives")))
    limited = asked.join(lists, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    found = dealt(rows, limited, shards, blocks).mapInArrow(cell_by_cell(mined), _MINED)
    order = Window.partitionBy("anchor_id", "positive_id", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    ranks = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranks.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, k: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, cell: int = CELL
) -> DataFrame:
    """For each anchor and each of its positives the k first rows of another label whose score is from low to high percent of the positive's.

    vectors and anchors: vec_id, embedding, label.  Returns anchor_id, positive_id, rank,
    negative_id, positive_score and negative_score.
    """
    spark = vectors.sparkSession
    ship(spark)
    pick = lambda df: usable(df.select(F.col("vec_id").cast("long"), "embedding", F.col("label").cast("string").alias("label"))).where("vec_id is not null and label is not null")
    rows, asked = pick(vectors), pick(anchors)
    if rows.schema != asked.schema:
        rows, asked = (x.withColumn("embedding", F.col("embedding").cast("array<double>")) for x in (rows, asked))
    # Repeated rows go by partial aggregation, so none of them crowds a shard.
    rows = cut(rows.distinct())
    asked = cut(asked.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("_a")).select("vec_id", "_a.embedding", "_a.label"))
    # An empty vector counts as one number.
    size = lambda df: df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.greatest(F.size("embedding"), F.lit(1)).cast("long")), F.lit(0)).alias("numbers")).first()
    here, there = size(rows), size(asked)
    shards = max(1, -(-here.numbers // cell), min(2 * spark.sparkContext.defaultParallelism, here.rows // LEAST_ROWS))
    return mine(rows, asked, shards, max(1, -(-there.numbers // cell)), positives, k, low, high, scale)
