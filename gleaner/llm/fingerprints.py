"""Document fingerprints by consistent weighted sampling.

A text is a set of terms (its words) weighted by their counts S.  For sample j
and term w, three values are drawn from a hash of (w, j): r and c from
Gamma(2, 1) and b from U(0, 1).  With t = floor(ln S / r + b) the term competes with
ln a = ln c - r (t - b) - r, and the least a of the text is its sample.  Two
texts have the same sample with the probability of their generalised Jaccard
similarity, sum(min(S, S')) / sum(max(S, S')).

The least a identifies the pair (w, t), because a is a continuous function of the
hash; a sample is therefore kept as 16 hashed bits of a, and the share of equal
samples is corrected for the chance of 2**-16 that two of them agree by accident.

Defined cases: null is the empty text; a text without words has the fixed
fingerprint of ``ffff``s, is like another such text (1) and unlike any other
(about 0); equal texts have equal fingerprints; repeated rows each give a row; an
empty table gives an empty result; ids may be any 64-bit number, repeated or null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ..session import ship
from ._spark import cut, repeated

#: Samples of a fingerprint; the standard error of a likeness is at most 0.5 / sqrt(SAMPLES).
SAMPLES = 128
_GROUP = 16
_PAIRS = 1 << 14


def _mix32(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x21F0AAAD)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x735A2D97)
    x ^= x >> np.uint32(15)
    return x


def _draws(terms: np.ndarray, js: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c - r and b for each term (rows) and sample (columns), from five uniform 16-bit draws."""
    low, high = terms.astype(np.uint32)[:, None], (terms >> np.uint64(32)).astype(np.uint32)[:, None]
    x = _mix32(low ^ js.astype(np.uint32)[None, :])
    y = _mix32(x ^ high)
    z = _mix32((y ^ low) + (js >> np.uint64(32)).astype(np.uint32)[None, :])
    half = np.uint32(0xFFFF)
    unit = lambda v: (v.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-16)
    r = -np.log(unit(x & half) * unit(x >> np.uint32(16)))
    c = -np.log(unit(y & half) * unit(y >> np.uint32(16)))
    return r, np.log(c) - r, unit(z & half)


def signatures(col: pa.Array, samples: int = SAMPLES) -> np.ndarray:
    """Fingerprints of texts: an array (texts, samples) of unsigned 16-bit samples."""
    w = T.words(col)
    out = np.full((len(col), samples), 0xFFFF, np.uint16)
    if not w.n:
        return out
    terms, code = np.unique(w.hashes(), return_inverse=True)
    pair, count = np.unique(w.row() * len(terms) + code, return_counts=True)
    row, term = pair // len(terms), pair % len(terms)
    weight = np.log(count.astype(np.float32))[:, None]
    begin = np.flatnonzero(np.diff(row, prepend=-1))
    rows = row[begin]
    ends = np.append(begin[1:], len(row))
    # Blocks of whole texts with about _PAIRS pairs, so that the arrays stay small.
    cuts = [0]
    while cuts[-1] < len(begin):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, begin[cuts[-1]] + _PAIRS, "right"))))
    blocks = []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        a, z = begin[lo], ends[hi - 1]
        many = np.flatnonzero(count[a:z] > 1)
        blocks.append((rows[lo:hi], begin[lo:hi] - a, term[a:z], many, term[a:z][many], weight[a:z][many]))
    seeds = T.stream(77, samples)
    for j in range(0, samples, _GROUP):
        r, lc, b = _draws(terms, seeds[j : j + _GROUP])
        once = lc + r * b  # ln a of a term that occurs once: ln S = 0, so t = 0
        for at, starts, own, many, which, ln in blocks:
            value = once[own]
            rr, bb = r[which], b[which]
            value[many] = lc[which] - rr * (np.floor(ln / rr + bb) - bb)
            least = np.minimum.reduceat(value, starts, axis=0)
            out[at, j : j + _GROUP] = T.mix(least.view(np.uint32).astype(np.uint64)) >> np.uint64(48)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated generalised Jaccard similarity of the rows of two arrays of fingerprints, 0 to 1."""
    chance = 2.0**-16
    return np.clip(((a == b).mean(1) - chance) / (1 - chance), 0, 1)


def as_text(sig: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in sig]


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id and fingerprint of each row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                yield pa.record_batch([part.column("doc_id"), pa.array(as_text(signatures(part.column("text"), samples)), pa.string())], names=["doc_id", "fingerprint"])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fingerprint string")


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
#: Bytes of a run of neighbouring rows, about; the runs that a table has at most; sampled keys for each run.
RUN_BYTES, MOST_RUNS, KEYS = 64 << 20, 100_000, 20
#: A key is hot if its equal rows are more than this share of a run's rows.
HOT = 0.25

Key = tuple[np.ndarray, np.ndarray, np.ndarray]  # none (no id), down (descending id), tie


def _key(batch: pa.RecordBatch) -> Key:
    ids = batch.column("doc_id")
    return ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), ~pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), batch.column("tie").to_numpy()


def _place(key: Key, bounds: Key) -> np.ndarray:
    """How many of the sorted bounds are not greater than each key: exact comparisons of integers."""
    n, m = len(bounds[0]), len(key[0])
    none, down, tie = (np.concatenate([b, k]) for b, k in zip(bounds, key, strict=True))
    order = np.lexsort((np.arange(n + m) >= n, tie, down, none))
    out = np.empty(m, np.int64)
    is_key = order >= n
    out[order[is_key] - n] = np.cumsum(~is_key)[is_key]
    return out


def _collected(rows: DataFrame) -> tuple[pa.Table, Key]:
    """Some rows (doc_id, tie, ...) in the order of their keys."""
    t = rows.toArrow().combine_chunks()
    batch = t.to_batches()[0] if t.num_rows else pa.RecordBatch.from_pylist([], schema=t.schema)
    key = _key(batch)
    order = np.lexsort((key[2], key[1], key[0]))
    return t.take(pa.array(order)), tuple(x[order] for x in key)


def _runs(docs: DataFrame, runs: int | None) -> tuple[DataFrame, int, DataFrame | None]:
    """Rows in runs of the order, the number of runs, and copies that need no order.

    docs has doc_id, text and tie.  The order of rows is by descending doc_id, rows
    without an id last, then by tie.  Bounds of runs are keys of a sample.  What a run has to know beyond
    its own rows is the row after its last: the first row, by an exact aggregate of the
    keys, of the next run that has rows (after the last run comes the first).  That row
    is sent to the run as well (ahead = 1).

    Of the rows that are equal in id and text, a hot group is reduced to one row by
    partial aggregation; the others of it are each followed by an equal one.
    """
    spark = docs.sparkSession
    keys = cut(docs.select("doc_id", "tie", F.octet_length("text").cast("long").alias("bytes")))
    total = keys.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    n = total["n"]
    if not n:
        return docs.withColumns({"ahead": F.lit(0), "run": F.lit(0)}), 1, None
    runs = runs or min(MOST_RUNS, max(-(-total["bytes"] // RUN_BYTES), 4 * spark.sparkContext.defaultParallelism))
    often = keys.groupBy("doc_id", "tie").agg(F.count("*").alias("copies")).where(F.col("copies") > max(8, int(HOT * n / runs)))
    hot, hot_key = _collected(often)  # at most runs / HOT rows
    copies = None
    if hot.num_rows:
        known = F.broadcast(spark.createDataFrame(hot.select(["doc_id", "tie"]).rename_columns(["_id", "_tie"])))
        same = docs["doc_id"].eqNullSafe(known["_id"]) & (docs["tie"] == known["_tie"])
        groups = cut(docs.join(known, same, "left_semi").groupBy("doc_id", "tie").agg(F.first("text").alias("text"), F.count("*").alias("copies")))
        copies = groups.where("copies > 1").select("doc_id", "text", (F.col("copies") - 1).alias("copies"))
        docs = docs.join(known, same, "left_anti").unionByName(groups.select("doc_id", "text", "tie"))
    share = min(1.0, KEYS * runs / n)
    sample, key = _collected(keys.where(F.pmod(F.xxhash64("doc_id", "tie", "bytes"), F.lit(1 << 30)) < int(share * (1 << 30))).select("doc_id", "tie").distinct())
    at = np.unique(np.arange(1, runs) * sample.num_rows // runs) if sample.num_rows else np.zeros(0, int)
    bounds = tuple(x[at] for x in key)

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = _key(batch)
                run = _place(key, bounds)
                order = np.lexsort((key[2], key[1], key[0]))
                first = order[np.unique(run[order], return_index=True)[1]]
                yield pa.record_batch([pa.array(run[first], pa.int32()), pa.array(key[0][first]), batch.column("doc_id").take(pa.array(first)), pa.array(key[1][first]), pa.array(key[2][first])], names=["run", "none", "doc_id", "down", "tie"])

    least = keys.select("doc_id", "tie").mapInArrow(firsts, "run int, none long, doc_id long, down long, tie long").groupBy("run").agg(F.min(F.struct("none", "down", "tie", "doc_id")).alias("_k"))
    first, first_key = _collected(least.select("run", "_k.doc_id", "_k.tie"))  # one row for each run
    number = first.column("run").to_numpy()
    sent = spark.sparkContext.broadcast((bounds, first_key, np.roll(number, 1)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, first_key, before = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            key = _key(batch)
            at = np.maximum(_place(key, first_key) - 1, 0)
            ahead = np.flatnonzero((first_key[0][at] == key[0]) & (first_key[1][at] == key[1]) & (first_key[2][at] == key[2]))
            for rows, flag, run in ((np.arange(batch.num_rows), 0, _place(key, bounds)), (ahead, 1, before[at[ahead]])):
                if len(rows):
                    part = batch if not flag else batch.take(pa.array(rows))
                    yield pa.record_batch([*(part.column(c) for c in ("doc_id", "text", "tie")), pa.array(np.full(len(rows), flag), pa.int32()), pa.array(run, pa.int32())], names=["doc_id", "text", "tie", "ahead", "run"])

    return docs.mapInArrow(deal, "doc_id long, text string, tie long, ahead int, run int"), runs, copies


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES, runs: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness.

    Edited text: the last floor(n/2) of a text's n code points are replaced by the
    first as many of the next document by descending doc_id; after the last row comes
    the first.  Rows with equal ids are ordered by a hash of their text, rows without
    an id come last.  The texts are shuffled once, by runs of ids.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("tie"))
    placed, runs, copies = _runs(docs, runs)
    placed = placed.repartitionById(runs, "run").sortWithinPartitions("run", "ahead", F.col("doc_id").desc_nulls_last(), "tie")

    def output(rows: list, texts: list, nexts: list) -> tuple:
        """Signatures of texts, and the output of rows (id, text, signature or its position in texts), each with the text after it and that one's signature or position."""
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for (_, t, _), (n, _) in zip(rows, nexts, strict=True)]
        sig = signatures(pa.array(texts + edited, pa.large_string()), samples)
        of = lambda s: sig[s] if isinstance(s, int) else s
        if not rows:
            return sig, None
        own, after, changed = np.stack([of(r[2]) for r in rows]), np.stack([of(s) for _, s in nexts]), sig[len(texts) :]
        return sig, pa.record_batch(
            [
                pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
                pa.array(as_text(own), pa.string()), pa.array(as_text(changed), pa.string()),
                pa.array(likeness(own, changed), pa.float64()), pa.array(likeness(own, after), pa.float64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: id, text, whether it was sent ahead, signature
        for batch in batches:
            for part in T.slices(batch, "text"):
                ids, texts, ahead = (part.column(c).to_pylist() for c in ("doc_id", "text", "ahead"))
                rows, nexts = [], []
                for i, text in enumerate(texts):
                    if held is not None and not held[2]:
                        rows.append((held[0], held[1], held[3]))
                        nexts.append((text, i))
                    held = (ids[i], text, ahead[i], i)
                sig, out = output(rows, texts, nexts)
                held = (*held[:3], sig[held[3]])
                if out is not None:
                    yield out

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that are followed by an equal one."""
        for batch in batches:
            for part in T.slices(batch, "text"):
                ids, texts = (part.column(c).to_pylist() for c in ("doc_id", "text"))
                out = output([(i, t, k) for k, (i, t) in enumerate(zip(ids, texts, strict=True))], texts, [(t, k) for k, t in enumerate(texts)])[1]
                yield pa.record_batch([*out.columns, part.column("copies")], names=[*out.schema.names, "copies"])

    done = placed.mapInArrow(run, EDITED)
    if copies is not None:
        each = repeated(copies.mapInArrow(alike, f"{EDITED}, copies long"), "copies", "copy")
        done = done.unionByName(each.drop("copies", "copy"))
    return done
