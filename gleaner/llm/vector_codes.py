"""Vector code compression: product quantisation with codebooks of whole numbers.

Vectors become whole numbers, floor(scale * x), and are cut into equal consecutive
parts.  Each part has a codebook, which starts as that part of the vectors with the
smallest ids.  A round broadcasts the codebooks; each task computes the distances of
its vectors' parts to all entries at once, |x|^2 - 2 x.c + |c|^2, by exact products
of matrices, takes the first least one, and adds up its parts by entry.  These sums,
at most a row for each entry and task, are merged by one grouped shuffle, and
each entry becomes the floor of its mean; an entry without parts stays.  After the last
round parts are assigned once more.

All values are whole numbers, so results do not depend on how rows are dealt or which
executors are lost.  A vector gives one byte for each part.

What is broadcast does not grow with the rows: 256 entries of the vectors' length.  If
vectors of several lengths occur, each length has codebooks of its own, and lengths
are taken together only as long as their codebooks hold at most ``NUMBERS`` numbers.

Defined cases: rows whose vector is null or holds a null or non-finite component are
dropped; rows without an id are coded but start no codebook; an id counts once in a
starting codebook, with its least vector; with fewer than 256 ids codebooks are
shorter, and if no row has an id, one entry of zeros is the codebook; a length that the number of parts does not divide is filled up with zeros;
an empty vector is at distance 0 from the first entry; a scaled component saturates
where the square root of 2**58 / length is exceeded, and the sum of a label's errors at the greatest long; rows that
are equal are coded each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from ._spark import cut
from ._vectors import by_length, products, scaled, usable

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: So that the errors of all parts of a vector add up to a long.
ROOM = 58
#: Numbers of the codebooks that are broadcast together, unless one length alone has more; vectors whose distances are held at once.
NUMBERS, STEP = 1 << 22, 4096

#: Of each length the codebooks, (parts, entries, numbers of a part).
Books = dict[int, np.ndarray]


def cut_up(v: np.ndarray, parts: int) -> np.ndarray:
    """(parts, vectors, numbers of a part): consecutive parts, the last one filled up with zeros."""
    width = -(-v.shape[1] // parts)
    whole = np.zeros((len(v), parts * width))
    whole[:, : v.shape[1]] = v
    return whole.reshape(len(v), parts, width).transpose(1, 0, 2)


def assign(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, ties to the first, and the squared distance."""
    entries = book.astype(np.float64)
    norm = (book * book).sum(1)
    code, error = np.empty(len(part), np.int64), np.empty(len(part), np.int64)
    for lo in range(0, len(part), STEP):
        x = part[lo : lo + STEP]
        apart = norm[None] - 2 * products(x, entries)
        best = apart.argmin(1)
        whole = x.astype(np.int64)
        code[lo : lo + STEP] = best
        error[lo : lo + STEP] = apart[np.arange(len(x)), best] + (whole * whole).sum(1)
    return code, error


def _scaled_parts(lists: pa.Array, scale: int, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for dim, (at, v) in by_length(lists).items():
        yield dim, at, cut_up(scaled(v, scale, ROOM), parts)


def _start(rows: DataFrame, dims: list[int], scale: int, parts: int, entries: int) -> Books:
    """The codebooks made of the smallest ids of each length."""
    out: Books = {}
    for dim in dims:
        own = rows.where(F.size("embedding") == dim).where("vec_id is not null")
        ids = [r.vec_id for r in own.select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
        # Ids go by partial aggregation, so that one that comes often is one row.
        chosen = own.where(F.col("vec_id") <= ids[-1]).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).orderBy("vec_id").toArrow() if ids else None
        v = np.zeros((1, dim)) if chosen is None else by_length(chosen.column("embedding").combine_chunks())[dim][1]
        out[dim] = cut_up(scaled(v, scale, ROOM), parts).astype(np.int64)
    return out


def _round(rows: DataFrame, books: Books, scale: int, parts: int) -> Books:
    """The codebooks after one round."""
    sent = rows.sparkSession.sparkContext.broadcast(books)
    width = max(b.shape[2] for b in books.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        sums, counts = {d: np.zeros_like(b) for d, b in known.items()}, {d: np.zeros(b.shape[:2], np.int64) for d, b in known.items()}
        for batch in batches:
            for dim, _, cut_vectors in _scaled_parts(batch.column("embedding"), scale, parts):
                for p, part in enumerate(cut_vectors):
                    code, _ = assign(part, known[dim][p])
                    order = np.argsort(code, kind="stable")
                    entry, begin = np.unique(code[order], return_index=True)
                    if part.shape[1]:
                        sums[dim][p, entry] += np.add.reduceat(part[order].astype(np.int64), begin)
                    counts[dim][p] += np.bincount(code, minlength=counts[dim].shape[1])
        for dim, n in counts.items():
            p, e = np.nonzero(n)
            if len(p):
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * sums[dim].shape[2], pa.int32()), pa.array(sums[dim][p, e].reshape(-1)))
                yield pa.record_batch([pa.array(np.full(len(p), dim, np.int32)), pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(n[p, e]), lists], names=["dim", "part", "entry", "n", "sums"])

    found = rows.select("embedding").mapInArrow(run, "dim int, part int, entry int, n long, sums array<long>")
    total = F.array(*(F.sum(F.get("sums", F.lit(i))) for i in range(width))) if width else F.array().cast("array<long>")
    new = {d: b.copy() for d, b in books.items()}
    for r in found.groupBy("dim", "part", "entry").agg(F.sum("n").alias("n"), total.alias("sums")).collect():  # a row for each entry
        own = new[r.dim]
        own[r.part, r.entry] = np.array(r.sums[: own.shape[2]], np.int64) // r.n
    return new


def _coded(rows: DataFrame, books: Books, scale: int, parts: int) -> DataFrame:
    """vec_id, label, code, error and codebooks_sha256 of rows whose lengths have codebooks."""
    digest = {d: hashlib.sha256(",".join(map(str, b.reshape(-1).tolist())).encode()).hexdigest() for d, b in books.items()}
    sent = rows.sparkSession.sparkContext.broadcast((books, digest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, names = sent.value
        for batch in batches:
            for dim, at, cut_vectors in _scaled_parts(batch.column("embedding"), scale, parts):
                found = [assign(part, known[dim][p]) for p, part in enumerate(cut_vectors)]
                code = [bytes(c).hex() for c in np.stack([c for c, _ in found], 1).astype(np.uint8)]
                own = batch.take(pa.array(at))
                yield pa.record_batch([own.column("vec_id"), own.column("label"), pa.array(code), pa.array(np.sum([e for _, e in found], 0)), pa.array([names[dim]] * len(at))], names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id long, label {kind}, code string, error long, codebooks_sha256 string")


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, numbers: int = NUMBERS) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of each row of vectors (vec_id, embedding, label) with a whole vector.

    code: two hex digits for each part, in order; error: the squared distance to the coded
    vector; label_error: the sum of the errors of all rows of the label, those without one together.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries: from 1 to 256, a byte's values")
    spark = vectors.sparkSession
    ship(spark)
    rows = cut(usable(vectors.select(F.col("vec_id").cast("long"), "label", "embedding")))
    groups: list[list[int]] = []
    held = 0
    for r in rows.select(F.size("embedding").alias("dim")).distinct().orderBy("dim").collect():
        if not groups or held + r.dim * entries > numbers:
            groups.append([])
            held = 0
        groups[-1].append(r.dim)
        held += r.dim * entries
    coded = None
    for dims in groups:
        own = rows if len(groups) == 1 else rows.where(F.size("embedding").between(dims[0], dims[-1]))
        books = _start(own, dims, scale, parts, entries)
        for _ in range(rounds):
            books = _round(own, books, scale, parts)
        some = _coded(own, books, scale, parts)
        coded = some if coded is None else coded.unionByName(some)
    if coded is None:
        return rows.select("vec_id", "label", F.lit("").alias("code"), *(F.lit(0).cast("long").alias(c) for c in ("error", "label_error")), F.lit("").alias("codebooks_sha256"))
    coded = cut(coded)
    most = F.lit((1 << 63) - 1)
    totals = cut(coded.groupBy(F.col("label").alias("_label")).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most.cast("decimal(38,0)")).cast("long").alias("label_error")))
    # Few labels are broadcast by their table's size; many are sorted and merged.
    joined = coded.join(totals, coded["label"].eqNullSafe(totals["_label"]))
    return joined.select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")
