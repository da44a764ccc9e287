import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from gleaner.llm import byte_bpe, token_counts
from tests.llm.corpus import AWKWARD, frame, ordinary

PARTS = ["a", "é", " ", "  ", "\n", "'s", "'re", "'", "1", "12", "!", "<|endoftext|>", "<|endo", "word", "中", "🙂", "\t", "x" * 30, " " * 20, "՘", "\U00010941"]


def texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 300))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_chunks_are_spliced_where_both_agree(library):
    rng = random.Random(5)
    for t in texts(400):
        want = len(library.encode(t, add_special_tokens=False))
        assert token_counts.count_by_chunks(t, library, chunk=rng.choice([60, 100, 200]), overlap=8) == want
    # No boundary in reach: the overlap is widened, to the whole rest if need be.
    for t in ("x" * 5000, "y" * 700 + " z " + "w" * 900):
        assert token_counts.count_by_chunks(t, library, chunk=100, overlap=8) == len(library.encode(t, add_special_tokens=False))


def test_counts_are_the_library_s(library):
    batch = texts(300, 4)
    assert token_counts.count(batch, library, huge=150) == [len(library.encode(t, add_special_tokens=False)) for t in batch]
    assert token_counts.count([], library) == []


def test_token_counts(spark, library):
    rows = AWKWARD + ordinary(n=20)
    got = sorted(map(tuple, token_counts.token_counts(frame(spark, rows)).collect()), key=str)
    want = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False))
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert got == sorted(want, key=str)
    assert token_counts.token_counts(frame(spark, [])).count() == 0


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.codec(byte_bpe.vocabulary())


def test_perfect_hash_is_minimal_and_perfect(codec):
    h = codec.hash
    assert sorted(h.slots.tolist()) == list(range(len(codec.keys)))
    import xxhash

    found = h.find(np.array([xxhash.xxh3_64_intdigest(k) for k in codec.keys], np.uint64))
    assert (found == np.arange(len(codec.keys))).all()


@pytest.mark.parametrize("keys", [[b"a"], [bytes([i]) for i in range(256)], [f"k{i}".encode() for i in range(1000)]])
def test_small_perfect_hashes(keys):
    assert sorted(byte_bpe.PerfectHash(keys).slots.tolist()) == list(range(len(keys)))


def test_encoding_is_the_library_s(codec):
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    batch = [t.replace("՘", "").replace("\U00010941", "") for t in texts(400, 9)]
    ids, at = codec.encode(batch)
    for t, a, b in zip(batch, at[:-1], at[1:], strict=True):
        assert ids[a:b].tolist() == plain.encode_ordinary(t) and codec.decode(ids[a:b]) == t.encode()
    codec.merged.clear()
    assert codec.encode(batch)[0].tolist() == ids.tolist()


def test_byte_bpe(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(byte_bpe.vocabulary(), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = AWKWARD + ordinary(n=10)
    got = sorted(map(tuple, byte_bpe.byte_bpe(frame(spark, rows)).collect()), key=str)
    want = []
    for i, t in rows:
        ids = plain.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    full = byte_bpe.byte_bpe(frame(spark, rows), ids=True).where("doc_id = 12").first()
    assert full.ids == plain.encode_ordinary(AWKWARD[-1][1]) and bytes(full.decoded).decode() == AWKWARD[-1][1]
    assert byte_bpe.byte_bpe(frame(spark, [])).count() == 0


@pytest.mark.parametrize("chunk", [64, 200])
def test_long_texts_go_through_chunks(spark, library, chunk):
    """Texts over twice a chunk, with an end of a chunk anywhere in words, spaces, special strings and one word without an end."""
    texts = [t for _, t in AWKWARD + ordinary(n=40) if t and len(t) < 30_000] + ["x" * 3000, " " * 900 + "a", "it's <|endoftext|> " * 90, "ab\n\n\t c" * 150, "ሕግ é🙂 " * 200]
    got = token_counts.token_counts(frame(spark, list(enumerate(texts)), False), huge=2 * chunk, chunk=chunk).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(library.encode(t, add_special_tokens=False)) for i, t in enumerate(texts)}
