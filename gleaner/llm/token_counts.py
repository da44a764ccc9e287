"""Token counts by overlap resynchronisation.

A huge text is encoded in overlapping chunks, with offsets.  Two neighbouring
chunks are spliced at a position at which both have a pre-token boundary that
is proven stable, so that the sum over the chunks is what the library gives for
the whole text, while memory stays bounded by a chunk.

Why a boundary p is stable.  The pre-tokenizer scans from left to right, never
looks behind, and looks at most ``MARGIN`` characters beyond a match.  So
* in the left chunk all pre-tokens before p are those of the whole text if at
  least MARGIN characters of the chunk follow p;
* in the right chunk all pre-tokens from p on are those of the whole text if the
  whole text has a boundary at p, which the left chunk shows;
* a special string (``<|endoftext|>``) that a chunk's edge cuts lies within
  MARGIN characters of that edge, so p keeps that distance from both edges.
Where no common boundary is found (one run of letters as long as the overlap)
the overlap is doubled and the right chunk starts earlier, the left one ends
later, until they agree or the chunk covers the rest.

A text is huge if it has more than ``HUGE`` characters, two chunks (both are parameters);
at sf0.1 that is 24 % of all characters.  Shorter texts are counted pre-token by
pre-token: each distinct pre-token of a slice is encoded once by the library and its
length is summed.  Those with a special string, or with characters on which regular
expression engines disagree (new or unassigned code points), are encoded whole.  All
three ways give the count that the library gives for the whole text.

Defined cases: null is the empty text (0 tokens); repeated rows each give a row; an
empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import _text as T

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
#: Characters of a text that is encoded in chunks, of a chunk, and of the first overlap.
HUGE, CHUNK, OVERLAP = 8192, 4096, 192
#: The longest special string has 13 characters; a contraction looks at three.
MARGIN = 16
SPECIAL = "<|endoftext|>"
#: Code points on which the Unicode tables of common regular expression engines differ.
UNSURE = "[՘֋֌ࡐ-೿₏-₟Ꟁ-꭯\U00010000-\U0001f2ff\U0001fb00-\U0010ffff]"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(1)
def _patterns():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN), regex.compile(UNSURE + "|" + regex.escape(SPECIAL))


def boundaries(encoding) -> tuple[np.ndarray, np.ndarray]:
    """Where each pre-token starts (in characters), and the number of tokens before it."""
    begins = np.fromiter((a for a, _ in encoding.offsets), np.int64, len(encoding))
    word = np.fromiter((-1 if w is None else w for w in encoding.word_ids), np.int64, len(encoding))
    new = np.ones(len(word), bool)
    # An added token stands alone and has a word of its own between its neighbours' or none.
    new[1:] = (word[1:] != word[:-1]) | (word[1:] < 0)
    at = np.flatnonzero(new)
    return begins[at], at


def tokens_before(encoding, p: int) -> int | None:
    """The number of tokens before character p, if a pre-token starts there; looks at that place only."""
    i = encoding.char_to_token(p)
    if i is None or encoding.token_to_chars(i)[0] != p:
        return None
    word = encoding.token_to_word(i)
    return i if i == 0 or word is None or word != encoding.token_to_word(i - 1) else None


def count_by_chunks(text: str, tok, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, of which only about a chunk is encoded at a time."""
    total, at, n = 0, 0, len(text)
    overlap = max(overlap, 3 * MARGIN)
    while n - at > chunk:
        wide, to = overlap, at + chunk
        while True:
            end = min(n, to + wide)
            if end == n:
                return total + len(tok.encode(text[at:], add_special_tokens=False))
            begin = max(at, to - wide)
            left = tok.encode(text[at:end], add_special_tokens=False)
            right, _ = boundaries(tok.encode(text[begin : end + MARGIN], add_special_tokens=False))
            stable = right[(right + begin > at) & (right >= MARGIN) & (right + begin <= end - MARGIN)] + begin
            found = next(((int(p), k) for p in stable[::-1] if (k := tokens_before(left, int(p) - at)) is not None), None)
            if found:
                at, total = found[0], total + found[1]
                break
            wide *= 2
    return total + len(tok.encode(text[at:], add_special_tokens=False))


#: Tokens of pre-tokens that a worker has met, for the tokenizer last used; emptied when full.
REMEMBERED = 500_000
_sizes: dict[str, int] = {}
_sizes_of: list = [None]


def piece_sizes(pieces: list[str], tok) -> np.ndarray:
    """Tokens of each of some distinct pre-tokens, as the library gives them."""
    if _sizes_of[0] is not tok:
        _sizes.clear()
        _sizes_of[0] = tok
    size = [_sizes.get(p, -1) for p in pieces]
    new = [i for i, k in enumerate(size) if k < 0]
    if len(_sizes) + len(new) > REMEMBERED:
        _sizes.clear()
    for i, e in zip(new, tok.encode_batch([pieces[i] for i in new], add_special_tokens=False), strict=True):
        size[i] = len(e)
        if len(pieces[i]) <= 64:
            _sizes[pieces[i]] = size[i]
    return np.array(size, np.int64)


def count(texts: list[str], tok, huge: int = HUGE, chunk: int = CHUNK) -> list[int]:
    """Tokens of each text as the library gives them for whole texts."""
    pattern, odd = _patterns()
    out = [0] * len(texts)
    whole, rows, pieces = [], [], []
    for i, text in enumerate(texts):
        if len(text) > huge:
            out[i] = count_by_chunks(text, tok, chunk)
        elif odd.search(text):
            whole.append(i)
        elif text:
            found = pattern.findall(text)
            rows.append((i, len(found)))
            pieces += found
    for i, e in zip(whole, tok.encode_batch([texts[i] for i in whole], add_special_tokens=False), strict=True):
        out[i] = len(e)
    if pieces:
        codes, distinct = pd.factorize(np.array(pieces, dtype=object))
        size = piece_sizes(distinct.tolist(), tok)
        begin = np.concatenate([[0], np.cumsum([k for _, k in rows])[:-1]])
        for (i, _), total in zip(rows, np.add.reduceat(size[codes], begin), strict=True):
            out[i] = int(total)
    return out


def token_counts(docs: DataFrame, limit: int = 1024, vocabulary_path: str | None = None, huge: int = HUGE, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each row of docs (doc_id, text).

    Texts of more than huge characters are encoded in overlapping chunks.
    """
    ship(docs.sparkSession)
    path = vocabulary_path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for batch in batches:
            for part in T.slices(batch, "text"):
                text = pc.fill_null(part.column("text"), "")
                n = count(text.to_pylist(), tok, huge, chunk)
                yield pa.record_batch(
                    [part.column("doc_id"), pc.cast(pc.binary_length(text), pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
