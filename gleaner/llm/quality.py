"""Quality classification by nearest-neighbour voting in a latent semantic space.

A text is a vector of counts of hashed terms: its words, trigrams of its character
classes (which see its shape, not its language), and how often a word repeats the word
before it or one within the last few.  Counts are damped, weighted by inverse document
frequency and projected on the leading singular vectors of a labelled sample.  Held out
at sf0.1 (1,344 documents): see the README for words and classes apart and together.  The projected, labelled vectors are of a fixed number and
size, so they are broadcast; every document's exact cosines with all of them are
computed in blocks, and the labels of its nearest neighbours vote, weighted by
similarity.

Training: at most ``LABELLED`` labelled documents that are not held out, chosen by a
hash of their ids; labels, language, source and ids are not part of a vector.

Defined cases: a null or empty text, and any text without a neighbour of positive
similarity, has the share of good documents in the sample as its score; without
any label the score is 0.5; repeated rows each give a row; several labels of a
document count by their mean (1 from 0.5 on), and of several texts of one id the
first by its terms is learned; an empty table gives an empty result; other columns are
ignored, or kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import _text as T
from ._spark import fold_of

LABELLED, RANK, NEIGHBOURS, POWER = 4096, 48, 25, 4
WORDS, CLASSES, EXTRA = 1024, 1024, 8
TERMS = WORDS + CLASSES
#: Words back to which a repetition is looked for.
LAGS = (1, 2, 3, 5, 8, 13)


def _classes() -> np.ndarray:
    c = np.full(256, 1, np.uint16)  # other bytes below 128
    c[97:123] = 2
    c[65:91] = 3
    c[48:58] = 4
    c[[9, 11, 12, 32]] = 5
    c[[10, 13]] = 6
    c[128:] = 2
    for i, mark in enumerate(b".,!?|*#$%&:;-'\"()/<>=_@+[]{}\\~^`"):
        c[mark] = 7 + i
    return c


_CLASS = _classes()
#: The column of a trigram of classes, six bits each.
_COLUMN = (T.mix(np.arange(1 << 18, dtype=np.uint64)) >> np.uint64(54)).astype(np.int64)


def term_counts(col: pa.Array) -> np.ndarray:
    """Counts of each text's terms, as shares of its length, damped: (texts, WORDS + CLASSES + EXTRA)."""
    data, off = T.utf8(col)
    n = len(off) - 1
    out = np.zeros((n, TERMS + EXTRA), np.float32)
    if not len(data):
        return out
    c = _CLASS[data].astype(np.uint32)
    gram = (c[:-2] << np.uint32(12)) | (c[1:-1] << np.uint32(6)) | c[2:]
    col_of = _COLUMN[gram]
    row = np.repeat(np.arange(n), np.diff(off))
    whole = row[:-2] == row[2:]
    flat = np.bincount(row[:-2][whole] * CLASSES + col_of[whole], minlength=n * CLASSES)
    size = np.maximum(np.diff(off) - 2, 1)[:, None]
    out[:, WORDS:TERMS] = np.sqrt(flat.reshape(n, CLASSES) / size)
    w = T.words_of(data, off)
    if w.n:
        h, r = w.hashes(0, fold=True), w.row()
        words = np.maximum(w.counts(), 1)
        flat = np.bincount(r * WORDS + (h % np.uint64(WORDS)).astype(np.int64), minlength=n * WORDS)
        out[:, :WORDS] = np.sqrt(flat.reshape(n, WORDS) / words[:, None])
        for i, lag in enumerate(LAGS):
            if len(h) > lag:
                same = (h[lag:] == h[:-lag]) & (r[lag:] == r[:-lag])
                out[:, TERMS + i] = np.sqrt(np.bincount(r[lag:][same], minlength=n) / words)
    return out


def leading_axes(x: np.ndarray, rank: int, rounds: int = 8, seed: int = 4) -> np.ndarray:
    """The leading right singular vectors of x, as columns, by subspace iteration."""
    rank = min(rank, *x.shape)
    wide = min(rank + 16, *x.shape)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(x.shape[1], wide)).astype(np.float32))[0]
    for _ in range(rounds):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, axes = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray((q @ axes.T)[:, :rank], np.float32)


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray  # (TERMS + EXTRA, RANK)
    vectors: np.ndarray  # (labelled, RANK), of length 1
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        v = (counts * self.idf) @ self.axes
        length = np.sqrt((v * v).sum(1, keepdims=True))
        return np.divide(v, length, out=np.zeros_like(v), where=length > 0)


def fit(counts: np.ndarray, labels: np.ndarray, rank: int = RANK) -> Model:
    width = TERMS + EXTRA
    if not len(counts):
        return Model(np.ones(width, np.float32), np.zeros((width, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32), 0.5)
    df = (counts > 0).sum(0)
    idf = (np.log((1 + len(counts)) / (1 + df)) + 1).astype(np.float32)
    model = Model(idf, leading_axes(counts * idf, rank), np.zeros(0), labels.astype(np.float32), float(labels.mean()))
    model.vectors = model.project(counts)
    return model


def vote(counts: np.ndarray, model: Model, neighbours: int = NEIGHBOURS, power: int = POWER, block: int = 1024) -> np.ndarray:
    """Score of each row of counts: the mean label of its nearest neighbours, weighted by a power of the cosine."""
    out = np.full(len(counts), model.prior)
    k = min(neighbours, len(model.labels))
    if not k:
        return out
    v = model.project(counts)
    for a in range(0, len(v), block):
        cos = v[a : a + block] @ model.vectors.T
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k] if k < cos.shape[1] else np.broadcast_to(np.arange(k), cos.shape)
        weight = np.maximum(np.take_along_axis(cos, near, 1), 0).astype(np.float64) ** power
        total = weight.sum(1)
        good = (weight * model.labels[near]).sum(1)
        out[a : a + block] = np.where(total > 0, good / np.where(total > 0, total, 1), model.prior)
    return np.clip(out, 0, 1)


def learn(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, labelled: int = LABELLED) -> Model:
    """A model from labels (doc_id, quality) of documents (doc_id, text) that are not held out."""
    ship(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("double")).where(F.col("quality").isNotNull() & (F.coalesce(fold_of(modulus), F.lit(-1)) != held_out))
    chosen = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                counts = term_counts(part.column("text"))
                yield pa.record_batch([part.column("doc_id"), part.column("quality"), pa.array([x.tobytes() for x in counts], pa.binary())], names=["doc_id", "quality", "counts"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    # One row for each label, also of an id that comes often.
    each = rows.mapInArrow(counted, "doc_id long, quality int, counts binary").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("counts").alias("counts"))
    sample = each.toArrow().sort_by([("doc_id", "ascending")])
    counts = np.frombuffer(b"".join(sample.column("counts").to_pylist()), np.float32).reshape(-1, TERMS + EXTRA)
    return fit(counts, np.array(sample.column("quality").to_pylist(), np.float64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each row of docs (doc_id, text)."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                yield pa.record_batch([part.column("doc_id"), pa.array(vote(term_counts(part.column("text")), sent.value), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, with a score of at least least."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                yield part.filter(pa.array(vote(term_counts(part.column("text")), sent.value) >= least, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of docs."""
    found = score(docs, learn(docs, labels, modulus, held_out))
    return found.select("doc_id", F.coalesce(fold_of(modulus) == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
