import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleaner.llm import packing
from gleaner.llm._spark import repeated
from gleaner.llm.near_duplicates import near_duplicates
from gleaner.llm.token_counts import token_counts
from tests.llm.corpus import AWKWARD, frame, ordinary


def slow_best_fit(sizes, sources, clusters, capacity):
    """The tightest compatible bin, found by looking at all of them."""
    bins, out = [], []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        fits = [(b[0], i) for i, b in enumerate(bins) if b[0] >= size and not (b[1] & s or b[2] & c)]
        if not fits:
            bins.append([capacity, 0, 0])
        i = min(fits)[1] if fits else len(bins) - 1
        bins[i] = [bins[i][0] - size, bins[i][1] | s, bins[i][2] | c]
        out.append(i)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_is_the_tightest_compatible_bin(seed):
    rng = random.Random(seed)
    n = 300
    sizes = sorted((rng.randint(1, 60) for _ in range(n)), reverse=True)
    sources = [1 << rng.randrange(6) if rng.random() < 0.9 else 0 for _ in range(n)]
    clusters = [1 << rng.randrange(80) if rng.random() < 0.4 else 0 for _ in range(n)]
    assert packing.best_fit(sizes, sources, clusters, 100) == slow_best_fit(sizes, sources, clusters, 100)


def check(rows, got, capacity):
    by_bin, total = {}, {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.size
        if r.bin is not None:
            by_bin.setdefault(r.bin, []).append(r)
    want = {}
    for i, t in rows:
        want[i] = want.get(i, 0) + len((t or "").encode())
    assert total == want
    for members in by_bin.values():
        members.sort(key=lambda r: r.slot)
        assert [r.slot for r in members] == list(range(len(members)))
        at = 0
        for r in members:
            assert r.bin_offset == at
            at += r.size
        assert at <= capacity


def test_pack(spark):
    rows = AWKWARD + ordinary(n=60)
    df = frame(spark, rows)
    got = packing.pack(df, capacity=700, shard_rows=20, per_source=1).collect()
    check(rows, got, 700)
    source = {(r.doc_id): r.source for r in df.collect()}
    text = dict(rows)
    seen = set()
    for r in got:
        if r.bin is not None and r.size < 700 and r.doc_id is not None:
            for key in (("s", r.bin, source[r.doc_id]), ("c", r.bin, text[r.doc_id])):
                assert key[2] is None or key not in seen
                seen.add(key)
    assert sum(r.bin is None for r in got) == sum(not t for _, t in rows)
    assert packing.pack(frame(spark, [])).count() == 0


def test_pack_by_a_column_of_sizes(spark):
    got = packing.pack(frame(spark, [(1, "a"), (2, "b"), (3, "c")]), capacity=10, size="n_chars").collect()
    assert sorted((r.doc_id, r.size) for r in got) == [(1, 1), (2, 1), (3, 1)]


def test_a_source_may_have_more_bits(spark):
    rows = frame(spark, [(i, f"text number {i:04d}") for i in range(1, 401)]).withColumn("source", F.lit("hot"))
    for per_source in (1, 3):
        got = packing.pack(rows, capacity=1000, per_source=per_source).collect()
        size = Counter(r.bin for r in got)
        assert max(size.values()) == per_source and len(size) == -(-400 // per_source)
    assert packing.best_fit([5, 5, 5], [3, 3, 3], [0, 0, 0], 100) == [0, 0, 1]


def test_a_row_that_comes_often_is_dealt_to_all_shards(spark):
    rows = [(None, "the same")] * 300 + [(7, "the same")] * 300 + [(i, f"other {i}") for i in range(100, 160)]
    got = packing.pack(frame(spark, rows), shard_rows=60).collect()
    check(rows, got, packing.CAPACITY)
    shards = Counter(r.bin >> 32 for r in got)
    assert len(shards) == 11 and max(shards.values()) < 120
    same = Counter(r.bin for r in got if r.size == len("the same"))
    assert max(same.values()) == 1


def test_pack_by_tokens_and_near_duplicate_classes(spark):
    """Sizes of op3 and classes of op10 as columns."""
    rows = [(i, t) for i, t in dict(ordinary(8, 50)).items() if t]
    docs = frame(spark, rows, False)
    known = docs.join(near_duplicates(docs).select("doc_id", "class_id"), "doc_id").join(token_counts(docs).select("doc_id", "n_tokens"), "doc_id")
    got = packing.pack(known, capacity=2048, size="n_tokens", cluster="class_id").collect()
    cls, tokens = ({r.doc_id: r[c] for r in known.collect()} for c in ("class_id", "n_tokens"))
    assert {r.doc_id: r.size for r in got} == tokens
    seen = [(r.bin, cls[r.doc_id]) for r in got]
    assert len(seen) == len(set(seen)) and len(set(cls.values())) < len(rows)


def test_copies_never_share_a_bin(spark):
    got = packing.pack(frame(spark, [(i * 28 + 28, "same text") for i in range(50)])).collect()
    assert len({r.bin for r in got}) == 50


def test_rows_are_repeated_by_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", 7), ("d", 8), ("e", 17), ("f", None), ("g", 10_000)], "name string, copies long")
    got = Counter((r.name, r.copy) for r in repeated(df, "copies", "copy", 4).collect())
    assert got == Counter((n, i) for n, c in (("a", 1), ("c", 7), ("d", 8), ("e", 17), ("g", 10_000)) for i in range(1, c + 1))
    assert repeated(df, "copies", "copy").count() == 10_033 and repeated(df, "copies", "copy").columns == ["name", "copies", "copy"]
