import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gleaner.llm import fingerprints as fp
from tests.llm.corpus import AWKWARD, frame, ordinary


def jaccard(a, b):
    x, y = Counter(a.split()), Counter(b.split())
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_collisions_are_generalised_jaccard():
    texts = [t for _, t in ordinary(5, 60)]
    pairs = [(a, b) for a, b in zip(texts, texts[1:] + texts[:1], strict=True) if a.split() and b.split()]
    pairs += [(a, a[: len(a) // 2] + b[: len(a) // 2]) for a, b in pairs] + [("a a a a b", "a b b b b"), ("q " * 50, "q " * 25)]
    sig = fp.signatures(pa.array([t for p in pairs for t in p]), 512)
    got = fp.likeness(sig[::2], sig[1::2])
    error = got - np.array([jaccard(a, b) for a, b in pairs])
    assert abs(error.mean()) < 0.01 and np.abs(error).max() < 0.12


def test_signatures_do_not_depend_on_neighbours():
    texts = [t for _, t in ordinary(6, 40)] + [None, "", "x", AWKWARD[-2][1]]
    whole = fp.signatures(pa.array(texts))
    assert all((whole[i] == fp.signatures(pa.array([t], pa.string()))[0]).all() for i, t in enumerate(texts))


def brute(spark, rows):
    """All columns of all rows, in one ordered list of the texts."""
    df = spark.createDataFrame([(k, t or "") for k, (_, t) in enumerate(rows)], "k long, text string").selectExpr("k", "xxhash64(text) as tie")
    tie = {r.k: r.tie for r in df.collect()}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, -(rows[k][0] or 0), tie[k]))
    texts = [rows[k][1] or "" for k in order]
    own = fp.signatures(pa.array(texts, pa.large_string()))
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, texts[1:] + texts[:1], strict=True)]
    changed = fp.signatures(pa.array(edited, pa.large_string()))
    near, after = fp.likeness(own, changed), fp.likeness(own, np.roll(own, -1, 0))
    return sorted(
        (str(rows[k][0]), len(t), hashlib.sha256(e.encode()).hexdigest(), f, c, float(a), float(b))
        for k, t, e, f, c, a, b in zip(order, texts, edited, fp.as_text(own), fp.as_text(changed), near, after, strict=True)
    )


def result(df, runs):
    return sorted((str(r.doc_id), *tuple(r)[1:]) for r in fp.edited_fingerprints(df, runs=runs).collect())


def large_ids(n=300):
    rng = np.random.default_rng(9)
    texts = [t for _, t in ordinary(n=60)]
    ids = [int(x) for x in rng.integers(-(1 << 62), 1 << 62, n)]
    ids[10:20] = [(1 << 62) + i for i in range(10)]  # equal as doubles
    ids[20:30] = [ids[0]] * 10
    ids[30:33] = [-(1 << 63), (1 << 63) - 1, 0]
    ids[40:60] = [None] * 20
    return [(i, f"{texts[k % 60]} {k}" if k % 9 else texts[k % 60]) for k, i in enumerate(ids)]


@pytest.mark.parametrize("runs", [1, 2, 8, 25, None])
def test_edited_texts(spark, runs):
    rows = AWKWARD + ordinary(n=40)
    assert result(frame(spark, rows), runs) == brute(spark, rows)


@pytest.mark.parametrize("runs", [8, 50])
def test_any_ids(spark, runs):
    rows = large_ids()
    assert result(frame(spark, rows), runs) == brute(spark, rows)


def test_hot_ids_and_hot_rows(spark):
    rows = [(7, f"text {i} of an id that comes often") for i in range(150)] + [(1 << 60, "one row that comes often")] * 120 + [(None, None)] * 90 + [(i, f"other text {i}") for i in range(60)]
    assert result(frame(spark, rows), 12) == brute(spark, rows)
    dealt, runs, copies = fp._runs(frame(spark, rows).selectExpr("doc_id", "coalesce(text, '') as text", "xxhash64(coalesce(text, '')) as tie"), 12)
    sizes = [r["count"] for r in dealt.groupBy("run").count().collect()]
    assert max(sizes) < 80 and {r.copies for r in copies.collect()} == {119, 89}


@pytest.mark.parametrize("rows", [[], [(1, "alone here")], [(None, "a"), (None, "b")], [(5, "x y"), (5, "x y"), (5, "z")], AWKWARD])
def test_edges(spark, rows):
    got = fp.edited_fingerprints(frame(spark, rows), runs=3).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(i), len(t or "")) for i, t in rows)


def test_fingerprints(spark):
    got = {r.doc_id: r.fingerprint for r in fp.fingerprints(frame(spark, [(1, "a b"), (2, "a b"), (3, None), (4, " ")])).collect()}
    assert got[1] == got[2] != got[3] == got[4]
