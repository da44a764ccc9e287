"""Vectorised text primitives shared by the operators of this subpackage.

Everything works on the raw UTF-8 buffers of an Arrow string column, so that
words are split and hashed without a Python object for each of them.  A word is
a maximal run of bytes other than 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text that is handled at once, in bytes.  A longer single text is its own slice.
SLICE_BYTES = 2 << 20

_GOLD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random unsigned 64-bit integers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLD) + np.uint64((seed * 0xD1342543DE82EF95 + 1) & _MASK))


def _bytes_table(seed: int, fold: bool) -> np.ndarray:
    t = stream(1000 + seed, 256)
    t[SPACE] = 0
    if fold:
        t[65:91] = t[97:123]
    return t


_TABLES = {(s, f): _bytes_table(s, f) for s in (0, 1) for f in (False, True)}
_BASE = 0x5851F42D4C957F2D
_powers = {_BASE: np.ones(1, np.uint64)}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 4096, 2 * (0 if have is None else len(have)))
        have = np.full(size, base & _MASK, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each row's offsets into them; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.type != pa.large_string():
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    body = col.buffers()[2]
    data = np.frombuffer(body, np.uint8)[off[0] : off[-1]] if body is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


@dataclass
class Words:
    """Words of some texts: row r holds the words first[r] .. first[r+1]-1, each at data[start:end]."""

    data: np.ndarray
    off: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def n(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self, seed: int = 0, fold: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; fold takes ASCII capitals as small letters."""
        if not self.n:
            return np.zeros(0, np.uint64)
        a = self.start[0]
        v = _TABLES[seed, fold][self.data[a:]]
        length = np.diff(np.append(self.start, len(self.data)))
        rel = np.arange(len(v), dtype=np.int64) - np.repeat(self.start - a, length)
        v *= powers(int(length.max()) + 1)[rel]
        return mix(np.add.reduceat(v, self.start - a))


def words(col: pa.Array) -> Words:
    data, off = utf8(col)
    return words_of(data, off)


def words_of(data: np.ndarray, off: np.ndarray) -> Words:
    if not len(data):
        z = np.zeros(0, np.int64)
        return Words(data, off, np.zeros(len(off), np.int64), z, z)
    word = ~SPACE[data]
    full = off[1:] > off[:-1]
    head = word.copy()
    head[1:] &= ~word[:-1]
    at = off[:-1][full]
    head[at] = word[at]
    tail = word.copy()
    tail[:-1] &= ~word[1:]
    at = off[1:][full] - 1
    tail[at] = word[at]
    start = np.flatnonzero(head)
    return Words(data, off, np.searchsorted(start, off), start, np.flatnonzero(tail) + 1)


def grams(h: np.ndarray, k: int, base: int = _BASE) -> np.ndarray:
    """Hash of the k items from each position on, by doubling; the last k-1 positions are left out."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, block, size, scale = None, 0, h, 1, base
    while k >> done.bit_length() >= 0:
        if k & size:
            at = out[1] if out else 0
            part = block[at : at + n]
            out = (part.copy() if not out else out[0] + part * np.uint64(pow(base, at, 1 << 64)), at + size)
        if size * 2 > k:
            break
        block = block[:-size] + block[size:] * np.uint64(scale)
        scale = scale * scale & _MASK
        size *= 2
    return mix(out[0])


def slices(batch: pa.RecordBatch, col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have at most limit bytes, or in single rows."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
