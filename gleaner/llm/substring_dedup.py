"""Substring deduplication by relative Lempel-Ziv parsing.

Every document is parsed from left to right into factors, each the copy of a passage
of a document with a smaller id.  A factor of ``width`` words or more is a duplicate
span.  The reference is indexed once for all documents, in blocks dealt by content,
so no block has to be sent to every document:

1.  Phrases.  Every window of ``width`` words has one anchor, the least hash of its
    ``seed``-word grams (the leftmost of equals).  Equal windows have equal anchors
    at the same place.  A run of windows with one anchor is a *phrase*, and an
    anchor's block of the index holds each distinct phrase once, with the place of
    its first occurrence (least doc_id, least word).  Where a text repeats a phrase at
    once, as in a line that comes a hundred times, the repetitions are one row.
2.  Matches.  A phrase that the block has from a smaller id is copied whole.  Where a
    block has several phrases, a match may begin or end inside a phrase.  There the
    windows of the phrases' first occurrences are indexed one by one, each at its
    first occurrence.
3.  Parse.  A factor begins at the first window that the index has from a smaller id
    and is extended as far as the index goes on in the same source at the next word;
    then the next factor begins (`parse`).  As the index holds each phrase, and each
    window of a divided phrase, once, the longest match is the only one.  Windows
    over a boundary of two factors are looked up like all others (2), so what is
    removed is exact.

All grouping is by content hashes (two independent ones of 64 bits) with partial
aggregation; texts are never gathered by a shared key, and hot passages or thousands
of copies need no list anywhere.  Joins on hot phrases can be split, for the index
has one row for a phrase.

Defined cases: a null text has no words; a document of fewer than ``width`` words
keeps all; an empty table gives an empty result; rows with equal ids count as one
document for "smaller", each keeps its own row; a row without an id neither loses
words nor serves as reference; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ..session import ship
from ._spark import cut, release

WIDTH, SEED = 50, 12
_CHAIN = 0x2545F4914F6CDD1D
_PHRASE = "doc_id long, tag int, anchor long, phrase long, start int, windows int, times int, again boolean"
#: Names of columns that are added to the documents on the way; no table has them.
PIECES, TAG = "__gleaner_pieces", "__gleaner_tag"


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


def _leftmost_least(g: np.ndarray, reach: int) -> np.ndarray:
    """The position of the least of g[i : i + reach], of equals the first, for each i.

    Minima of a sliding range from running minima of blocks, in both directions; the
    low 16 bits of a key are its place within a stretch of the array.
    """
    n = len(g) - reach + 1
    out = np.empty(n, np.int64)
    step = (1 << 16) - reach
    for lo in range(0, n, step):
        size = min(step, n - lo)
        own = g[lo : lo + size + reach - 1]
        key = np.full(-(-len(own) // reach) * reach, ~np.uint64(0))
        key[: len(own)] = (own & ~np.uint64(0xFFFF)) | np.arange(len(own), dtype=np.uint64)
        blocks = key.reshape(-1, reach)
        ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        back = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        out[lo : lo + size] = lo + (np.minimum(ahead[:size], back[reach - 1 : reach - 1 + size]) & np.uint64(0xFFFF)).astype(np.int64)
    return out


def phrases(w: T.Words, width: int = WIDTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: row, anchor, phrase hash, first window (word of the row), windows."""
    empty = np.zeros(0, np.int64)
    n = w.n - width + 1
    if n <= 0:
        return empty, empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
    g = T.grams(w.hashes(0), seed)
    at = _leftmost_least(g, width - seed + 1)
    row = w.row()
    good = row[:n] == row[width - 1 :]
    new = np.ones(n, bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:n] != row[: n - 1]) | (good[1:] != good[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, n))
    keep = good[begin]
    begin, size = begin[keep], size[keep]
    # The phrase's hash comes from other word hashes than its anchor.
    h = w.hashes(1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(T.mix(h ^ np.uint64(_CHAIN)) * T.powers(len(h), _CHAIN))])
    stop = begin + size + width - 1
    phrase = T.mix((total[stop] - total[begin]) * T.powers(w.n + 1, _inverse(_CHAIN))[begin] + size.astype(np.uint64))
    return row[begin], g[at[begin]], phrase, begin - w.first[row[begin]], size


def repeated(row: np.ndarray, phrase: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each run of equal phrases that follow each other, and how many they are."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (phrase[1:] != phrase[:-1]) | (size[1:] != size[:-1]) | (start[1:] != start[:-1] + size[:-1])
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(row)))


def _again(row: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Which phrases their own text has had before."""
    order = np.lexsort((np.arange(len(row)), phrase, row))
    out = np.zeros(len(row), bool)
    out[order[1:]] = (row[order[1:]] == row[order[:-1]]) & (phrase[order[1:]] == phrase[order[:-1]])
    return out


def _tagged(docs: DataFrame) -> DataFrame:
    """docs with TAG, which tells texts of one id apart."""
    return docs.withColumn(TAG, F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit((1 << 31) - 1)).cast("int"))


def pieces(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """doc_id, TAG and PIECES of the texts with duplicates: runs of windows that the index has from a smaller id.

    A piece is start, windows (in words and windows of the text), times (how often it
    comes there, one after the other), source (a doc_id) and at (a word of the source).
    """
    texts = _tagged(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))).where("doc_id is not null")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                row, anchor, phrase, start, size = phrases(T.words(part.column("text")), width, seed)
                first, times = repeated(row, phrase, start, size)
                row, anchor, phrase, start, size = (x[first] for x in (row, anchor, phrase, start, size))
                of = pa.array(row)
                yield pa.record_batch(
                    [
                        part.column("doc_id").take(of), part.column(TAG).take(of), pa.array(anchor.view(np.int64)), pa.array(phrase.view(np.int64)),
                        pa.array(start, pa.int32()), pa.array(size, pa.int32()), pa.array(times, pa.int32()), pa.array(_again(row, phrase)),
                    ],
                    names=["doc_id", "tag", "anchor", "phrase", "start", "windows", "times", "again"],
                )

    found = cut(texts.mapInArrow(index, _PHRASE))
    # The first place of a phrase: a text's repetitions are left out, so ties are those of equal rows.
    first_place = F.min_by("start", F.when(~F.col("again"), F.col("doc_id"))).alias("at")
    blocks = cut(found.groupBy("anchor", "phrase").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"), first_place))
    # Anchors with several phrases: matches may end inside one.
    several = cut(blocks.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    marked = cut(
        blocks.join(several.withColumn("several", F.lit(True)), "anchor", "left")
        .where("several or last > source")
        .select("anchor", "phrase", "source", "at", F.coalesce("several", F.lit(False)).alias("several"))
    )
    release(blocks, several)
    matched = cut(found.join(marked, ["anchor", "phrase"]).where("doc_id > source or several").select("doc_id", "tag", "start", "windows", "times", "source", "at"))
    release(found, marked)
    whole = matched.where("doc_id > source")
    # Windows of first occurrences, one by one.  A set, so rows that come often are one.
    open_runs = matched.where("doc_id = source").groupBy("doc_id", F.col("tag").alias(TAG)).agg(F.collect_set(F.struct("start", (F.col("windows") * F.col("times")).alias("windows"))).alias(PIECES))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                w = T.words(part.column("text"))
                runs = part.column(PIECES)
                lists = runs.flatten()
                start, size = (lists.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
                row = np.repeat(np.arange(len(runs)), np.diff(runs.offsets.to_numpy()))
                if not len(row):
                    continue
                each = np.repeat(row, size)
                pos = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                order = np.lexsort((pos, each))
                each, pos = each[order], pos[order]
                at = w.first[each] + pos
                a, b = T.grams(w.hashes(0), width)[at], T.grams(w.hashes(1), width)[at]
                own = pa.array(each)
                yield pa.record_batch(
                    [part.column("doc_id").take(own), part.column(TAG).take(own), pa.array(pos, pa.int32()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(_again(each, a))],
                    names=["doc_id", "tag", "start", "a", "b", "again"],
                )

    asked = texts.join(open_runs, ["doc_id", TAG]).select("doc_id", TAG, "text", PIECES)
    seen = cut(asked.mapInArrow(windows, "doc_id long, tag int, start int, a long, b long, again boolean"))
    earlier = cut(seen.groupBy("a", "b").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"), first_place).where("last > source").select("a", "b", "source", "at"))
    single = cut(seen.join(earlier, ["a", "b"]).where("doc_id > source").select("doc_id", "tag", "start", F.lit(1).alias("windows"), F.lit(1).alias("times"), "source", "at"))
    release(seen, earlier)
    both = whole.unionByName(single)
    return both.groupBy("doc_id", F.col("tag").alias(TAG)).agg(F.collect_set(F.struct("start", "windows", "times", "source", "at")).alias(PIECES))


def parse(row: np.ndarray, start: np.ndarray, windows: np.ndarray, source: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """The factors of some texts, from left to right, each as long as its source goes on: row, start, windows, source, at."""
    order = np.lexsort((start, row))
    row, start, windows, source, at = (x[order] for x in (row, start, windows, source, at))
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (source[1:] != source[:-1]) | (start[1:] != start[:-1] + windows[:-1]) | (at[1:] - start[1:] != at[:-1] - start[:-1])
    begin = np.flatnonzero(new)
    total = np.add.reduceat(windows, begin) if len(begin) else windows
    return row[begin], start[begin], total, source[begin], at[begin]


def _parsed(lists: pa.Array) -> tuple[np.ndarray, ...]:
    """The factors of a slice of texts with their PIECES."""
    full = lists.fill_null([]) if lists.null_count else lists
    inner = full.flatten()
    row = np.repeat(np.arange(len(full)), np.diff(full.offsets.to_numpy()))
    start, windows, times, source, at = (inner.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5))
    each = np.repeat(np.arange(len(row)), times)
    nth = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
    return parse(row[each], start[each] + nth * windows[each], windows[each], source[each], at[each])


def factors(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """The factors of width words and more of docs: doc_id, start, words, source_id, source_start (in words).

    A factor's words are those of the source from source_start on.  Rows that come
    often have their factors once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, windows, source, at = _parsed(batch.column(PIECES))
            yield pa.record_batch(
                [batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(windows + (width - 1)), pa.array(source), pa.array(at)],
                names=["doc_id", "start", "words", "source_id", "source_start"],
            )

    ship(docs.sparkSession)
    return pieces(docs, width, seed).mapInArrow(run, "doc_id long, start long, words long, source_id long, source_start long")


def removed_words(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """docs, all columns, with TAG and PIECES."""
    ship(docs.sparkSession)
    covered = cut(pieces(docs, width, seed))
    return _tagged(docs).join(covered, ["doc_id", TAG], "left")


def _apply(part: pa.RecordBatch, width: int) -> tuple[T.Words, np.ndarray]:
    """The words of a slice, and which of them go."""
    w = T.words(part.column("text"))
    gone = np.zeros(w.n + 1, np.int64)
    row, start, windows, _, _ = _parsed(part.column(PIECES))
    np.add.at(gone, w.first[row] + start, 1)
    np.add.at(gone, w.first[row] + start + windows + (width - 1), -1)
    return w, np.cumsum(gone[:-1]) > 0


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def substring_digests(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                w, gone = _apply(part, width)
                total = np.concatenate([[0], np.cumsum(gone)])
                removed = total[w.first[1:]] - total[w.first[:-1]]
                digest = []
                for i, text in enumerate(part.column("text").to_pylist()):
                    own = (text or "").encode().split()
                    if removed[i]:
                        own = [x for x, g in zip(own, gone[w.first[i] : w.first[i + 1]].tolist(), strict=True) if not g]
                    digest.append(hashlib.sha256(b" ".join(own)).hexdigest())
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(w.counts(), pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    return removed_words(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), width, seed).mapInArrow(run, RESULT)


def kept_texts(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """docs, all columns, their texts without duplicate spans; a document of which nothing is left goes.

    A text that loses nothing stays as it is; a removed run of words goes with the
    white space after it.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                w, gone = _apply(part, width)
                total = np.concatenate([[0], np.cumsum(gone)])
                removed = total[w.first[1:]] - total[w.first[:-1]]
                out = part.column("text").to_pylist()
                for i in np.flatnonzero(removed):
                    raw, lo, hi, base = out[i].encode(), int(w.first[i]), int(w.first[i + 1]), int(w.off[i])
                    keep = ~gone[lo:hi]
                    begin = w.start[lo:hi] - base
                    stop = np.append(begin[1:], len(raw))
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], keep, [False]]).astype(np.int8)))
                    out[i] = b"".join(raw[begin[a] : stop[b - 1]] for a, b in zip(edge[::2], edge[1::2], strict=True)).decode().strip()
                cols = [pa.array(out, part.column("text").type) if c == "text" else part.column(c) for c in names]
                yield pa.record_batch(cols, names=names).filter(pa.array((removed == 0) | (removed < w.counts())))

    return removed_words(docs, width, seed).mapInArrow(run, docs.schema)
