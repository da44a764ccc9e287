import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from gleaner.llm import _text as T

TEXTS = st.lists(st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=40)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_a_plain_split(texts):
    w = T.words(pa.array(texts, pa.string()))
    got = [[bytes(w.data[a:b]) for a, b in zip(w.start[lo:hi], w.end[lo:hi], strict=True)] for lo, hi in zip(w.first[:-1], w.first[1:], strict=True)]
    assert got == [(t or "").encode().split() for t in texts]
    flat = [x for row in got for x in row]
    assert len(set(w.hashes().tolist())) == len(set(flat)) and len(w.hashes(1)) == len(flat)


def test_hashes_do_not_depend_on_the_place():
    a = T.words(pa.array(["b c", "a b c"])).hashes()
    assert a[0] == a[3] and a[1] == a[4]
    assert T.words(pa.array(["AbÉ"])).hashes(0, True)[0] == T.words(pa.array(["xx abÉ"])).hashes(0, True)[1]


def test_grams():
    h = T.stream(1, 90)
    for k in (1, 2, 5, 25, 50, 63, 64, 90, 91):
        g = T.grams(h, k)
        assert len(g) == max(0, 91 - k) and len(np.unique(g)) == len(g)
        if k <= 80:
            assert (T.grams(h[10:], k) == g[10:]).all()


def test_slices():
    batch = pa.record_batch([pa.array(["a" * 10, None, "b" * 50, "", "c" * 5])], names=["t"])
    parts = [p.column("t").to_pylist() for p in T.slices(batch, "t", 20)]
    assert [x for p in parts for x in p] == batch.column("t").to_pylist() and all(len(p) == 1 or sum(len(x or "") for x in p) <= 20 for p in parts)
    assert not list(T.slices(batch.slice(0, 0), "t"))
