"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1: a minimal perfect hash over the vocabulary (hash and displace: 64-bit
hashes are dealt to buckets, the largest bucket first gets the displacement that
puts all its keys on free slots).  One displacement, one slot and one comparison
of bytes decide whether a whole pre-token is a token.
Tier 2: for any other pre-token, a heap of candidate merges over a doubly linked
list of byte parts: the lowest rank, then the leftmost pair, is merged first,
which is the order of the library.

The pre-tokens of a slice are factorised first, so either tier sees each distinct
pre-token once; those that tier 2 resolved are remembered in a bounded table.

Defined cases: null is the empty text (no ids, hash of no bytes); repeated rows
each give a row; an empty table gives an empty result; other columns of the input are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import _text as T

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Pre-tokens whose merges a worker remembers; the table is emptied when full.
REMEMBERED = 400_000


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class PerfectHash:
    """A minimal perfect hash of distinct byte strings: n keys, n slots."""

    def __init__(self, keys: list[bytes], load: int = 4):
        n = self.n = len(keys)
        self.buckets = max(1, n // load)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, n)
        bucket = self._bucket(h)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        self.shift = np.zeros(self.buckets, np.uint64)
        self.slots = np.zeros(n, np.int64)
        free = np.ones(n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            if not sizes[b]:
                break
            members = order[ends[b] - sizes[b] : ends[b]]
            at = 0
            while True:
                tries = np.arange(at, at + 64, dtype=np.uint64)
                slot = self._slot(h[members][None, :], tries[:, None])
                fits = free[slot].all(1)
                for t in np.flatnonzero(fits):
                    if len(set(slot[t].tolist())) == len(members):
                        break
                else:
                    at += 64
                    continue
                self.shift[b] = tries[t]
                free[slot[t]] = False
                self.slots[slot[t]] = members
                break

    def _bucket(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)

    def _slot(self, h: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (T.mix(h + shift * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The one key that each hash can belong to, as its position in keys."""
        return self.slots[self._slot(h, self.shift[self._bucket(h)])]


class Codec:
    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, "rb") as f:
            pairs = [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in f if line.strip())]
        self.ranks = dict(pairs)
        self.keys = [k for k, _ in pairs]
        self.ids = np.array([v for _, v in pairs], np.uint32)
        self.hash = PerfectHash(self.keys)
        self.bytes_of = {v: k for k, v in pairs}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.merged: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Tier 2: the ids of a pre-token that is not a token."""
        n, ranks = len(piece), self.ranks
        end = list(range(1, n + 1))  # the part that starts at i ends at end[i]; -1: it was merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if mid < 0 or mid >= n or end[mid] != stop:
                continue  # one of the two parts has changed since
            end[i], end[mid] = stop, -1
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (j := before[i]) >= 0 and (r := ranks.get(piece[j:stop])) is not None:
                heapq.heappush(heap, (r, j, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the offsets of each text's ids."""
        found = [self.pattern.findall(t) for t in texts]
        pieces = np.array([p for x in found for p in x], dtype=object)
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        codes, distinct = pd.factorize(pieces)
        raw = [p.encode() for p in distinct]
        key = self.hash.find(np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw)))
        size = np.ones(len(raw), np.int64)
        first = self.ids[key]
        keys, merged = self.keys, self.merged
        missed = [i for i, (k, r) in enumerate(zip(key.tolist(), raw, strict=True)) if keys[k] != r]
        longer = []
        for i in missed:
            ids = merged.get(distinct[i])
            if ids is None:
                ids = self.merge(raw[i])
                if len(raw[i]) <= 64:
                    if len(merged) >= REMEMBERED:
                        merged.clear()
                    merged[distinct[i]] = ids
            longer.append(ids)
        rows = np.array(missed, np.int64)
        size[rows] = np.fromiter(map(len, longer), np.int64, len(longer))
        begin = np.concatenate([[0], np.cumsum(size)])
        flat = np.zeros(begin[-1], np.uint32)
        flat[begin[:-1]] = first
        if len(rows):
            spread = np.fromiter(chain.from_iterable(longer), np.uint32)
            k = size[rows]
            flat[np.repeat(begin[rows] - np.concatenate([[0], np.cumsum(k)[:-1]]), k) + np.arange(k.sum())] = spread
        k = size[codes]
        at = np.concatenate([[0], np.cumsum(k)])
        ids = flat[np.repeat(begin[codes] - at[:-1], k) + np.arange(at[-1])]
        return ids, at[np.concatenate([[0], np.cumsum([len(x) for x in found])])]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@lru_cache(4)
def codec(path: str) -> Codec:
    return Codec(path)


def byte_bpe(docs: DataFrame, vocabulary_path: str | None = None, ids: bool = False) -> DataFrame:
    """Each text of docs (doc_id, text) encoded and decoded again: doc_id, n_tokens and the two digests.

    With ids, the columns ids (array<long>) and decoded (binary) too.
    """
    ship(docs.sparkSession)
    path = vocabulary_path or vocabulary()
    schema = SCHEMA + (", ids array<long>, decoded binary" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for part in T.slices(batch, "text"):
                flat, at = c.encode(pc.fill_null(part.column("text"), "").to_pylist())
                own = [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
                back = [c.decode(x) for x in own]
                cols = [
                    part.column("doc_id"), pa.array(np.diff(at), pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in own], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    cols += [pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())), pa.array(back, pa.binary())]
                    names += ["ids", "decoded"]
                yield pa.record_batch(cols, names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
