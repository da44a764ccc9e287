import hashlib
import os
import random
import string

import numpy as np
import pytest

from gleaner.llm import _graph, _spark, _text, near_duplicates as nd, substring_dedup as sd
from tests.llm.corpus import AWKWARD, frame, ordinary


# ------------------------------------------------------------------ substrings


def kept(rows, width):
    """n_words, n_removed and digest of each row, window by window."""
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[k : k + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, width, seed_words", [(1, 50, 25), (2, 12, 6), (3, 12, 5), (4, 9, 4)])
def test_substrings_match_brute_force(spark, seed, width, seed_words):
    rows = ordinary(seed)
    got = sd.substring_digests(frame(spark, rows, False), width, seed_words)
    assert sorted(map(tuple, got.collect()), key=str) == kept(rows, width)


def test_substrings_of_awkward_documents(spark):
    rows = AWKWARD + [(3, "other text of an id that comes twice"), (20, AWKWARD[-2][1]), (21, "pre " + AWKWARD[-2][1] + " post")]
    got = sd.substring_digests(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == kept(rows, 50)
    assert sd.substring_digests(frame(spark, [])).count() == 0


def test_repeats_within_one_document_stay(spark):
    text = " ".join(f"a{i}" for i in range(60))
    rows = [(1, f"{text} {text}"), (2, f"x {text}  y\n{text} z")]
    df = frame(spark, rows)
    out = {r.doc_id: r.text for r in sd.kept_texts(df).collect()}
    assert out[1] == rows[0][1] and out[2] == "x y\nz"
    assert sd.kept_texts(df).columns == df.columns


def test_a_document_of_which_nothing_is_left_goes(spark):
    text = " ".join(f"a{i}" for i in range(60))
    got = sd.kept_texts(frame(spark, [(1, text), (2, text), (3, text.replace(" ", "\n")), (4, None), (5, "")])).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.text) == [(1, text)] and sorted(r.doc_id for r in got) == [1, 4, 5]


# ------------------------------------------------------------------ near duplicates


def shingles(t):
    w = "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def classes(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p in range(n):
        for q in range(p):
            if sets[p] and sets[q] and len(sets[p] & sets[q]) >= threshold * len(sets[p] | sets[q]) - 1e-9:
                links[p] += 1
                links[q] += 1
                root[find(p)] = find(q)
    least = {}
    for p in range(n):
        if rows[p][0] is not None and sets[p]:
            least[find(p)] = min(least.get(find(p), rows[p][0]), rows[p][0])
    return sorted(((i, least.get(find(p)) if sets[p] else i, links[p]) for p, (i, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_duplicates_match_brute_force(spark, seed):
    rows = ordinary(seed, 90)
    got = nd.near_duplicates(frame(spark, rows, False))
    assert sorted(map(tuple, got.collect()), key=str) == classes(rows)


def test_near_duplicates_of_awkward_documents(spark):
    rows = AWKWARD + [(30, AWKWARD[9][1]), (31, AWKWARD[-2][1] + " more")]
    got = nd.near_duplicates(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == classes(rows)
    assert nd.near_duplicates(frame(spark, [])).count() == 0


def near_copies(n, words=200):
    base = [f"b{i}" for i in range(words)]
    return [(i, " ".join([*base[: i * 3 % words], f"x{i}", *base[i * 3 % words + 1 :]])) for i in range(n)]


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    """One group of near copies over many blocks gives the counts of brute force."""
    monkeypatch.setattr(nd, "BLOCK_NODES", 7)
    rows = near_copies(60)
    rows += [(1000 + i, rows[5][1]) for i in range(30)] + [(2000 + i, f"{rows[9][1]} tail{i}") for i in range(5)]
    got = nd.near_duplicates(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == classes(rows)


def test_compare_counts_each_pair_once():
    h = [np.unique(np.random.default_rng(i).integers(0, 500, 60).astype(np.uint64)) for i in range(40)]
    off = np.concatenate([[0], np.cumsum([len(x) for x in h])])
    links, root = nd.compare(np.zeros(40, int), np.ones(40, int), np.concatenate(h), off, (0, 0), 0.05, step=9)
    pairs = [(i, j) for i in range(40) for j in range(i) if len(np.intersect1d(h[i], h[j])) >= 0.05 * len(np.union1d(h[i], h[j]))]
    assert links.tolist() == [sum(i in p for p in pairs) for i in range(40)] and (root <= np.arange(40)).all()


def test_one_row_that_comes_often(spark):
    rows = [(3, "the very same row of a few words")] * 300 + [(4, "the very same row of a few words"), (5, "some other words here for once")]
    assert sorted(map(tuple, nd.near_duplicates(frame(spark, rows)).collect())) == sorted([(3, 3, 300)] * 300 + [(4, 3, 300), (5, 5, 0)])
    assert sorted(r.doc_id for r in nd.one_of_each(frame(spark, rows)).collect()) == [3, 5]


def test_one_of_each(spark):
    rows = ordinary(4, 60) + [(2, "twice the same row here"), (2, "twice the same row here"), (None, "without an id"), (None, "without an id"), (7, None), (7, None), (None, None), (None, "")]
    df = frame(spark, rows)
    got = nd.one_of_each(df)
    assert got.columns == df.columns
    words = [(i, t) for i, t in rows if (t or "").split()]
    stay = sorted({c for _, c, _ in classes(words) if c is not None})
    found = [r.doc_id for r in got.collect()]
    blank = [i for i, t in rows if not (t or "").split()]
    assert sorted(i for i in found if i is not None) == sorted(stay + list({i for i in blank if i is not None}))
    assert sum(i is None for i in found) == 1 + blank.count(None)


def test_different_texts_of_one_id_both_stay(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(5, a), (5, b), (6, b), (5, b + " more"), (None, a), (None, c), (8, c), (5, "   "), (5, b.replace(" ", "\n"))]
    got = [(r.doc_id, r.text) for r in nd.one_of_each(frame(spark, rows)).collect()]
    assert len(got) == 4 and (5, a) in got and (8, c) in got and (5, "   ") in got and sum(i == 5 and t.split()[:1] == ["b0"] for i, t in got) == 1


def test_recall_on_the_tables(spark):
    """Links against a brute-force join by an inverted index of shingles."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in nd.near_duplicates(docs).collect()}
    holders, common, all_sets = {}, {}, {i: shingles(t) for i, t in rows}
    for i, s in sorted(all_sets.items()):
        for x in s:
            for j in holders.setdefault(x, []):
                common[j, i] = common.get((j, i), 0) + 1
            holders[x].append(i)
    links = dict.fromkeys(all_sets, 0)
    for (i, j), n in common.items():
        if n >= 0.8 * (len(all_sets[i]) + len(all_sets[j]) - n) - 1e-9:
            links[i] += 1
            links[j] += 1
    true = sum(links.values())
    assert true > 100 and all(r.n_links <= links[i] for i, r in got.items())
    assert sum(r.n_links for r in got.values()) >= 0.99 * true


# ------------------------------------------------------------------ the forest


def test_prefix_depth():
    d = nd.prefix_depth(0.8, 0.999, 20)
    assert 1 - (1 - 0.8**d) ** 20 >= 0.999 > 1 - (1 - 0.8 ** (d + 1)) ** 20
    assert nd.prefix_depth(0.1, 0.9999, 2) == 1


@pytest.mark.parametrize("changed, want", [(1, 8), (9, 5)])
def test_prefixes_are_as_long_as_the_partners_allow(spark, changed, want):
    """Very near copies are met by long prefixes; copies near the threshold make them shorter."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    texts = []
    for g in range(30):
        base = [f"g{g}w{i}" for i in range(400)]
        for c in range(4):
            own = list(base)
            for i in rng.choice(400, changed, replace=False) if c else ():
                own[i] = f"c{c}x{i}"
            texts.append(" ".join(own))
    h, off = nd.sets(_text.words(pa.array(texts)))
    _, sketch = nd.signatures(h, off)
    nodes = spark.createDataFrame([(i, [int(x) for x in row]) for i, row in enumerate(sketch.view(np.int64))], "n long, sketch array<long>")
    assert nd.matched_depth(nodes, len(texts), 0.8, 0.999, nd.TREES, nd.DEPTH) == want
    assert nd.matched_depth(nodes.limit(1), 1, 0.8, 0.999, nd.TREES, nd.DEPTH) == nd.matched_depth(nodes.limit(0), 0, 0.8, 0.999, nd.TREES, nd.DEPTH) == nd.prefix_depth(0.8, 0.999)


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 62, 900).astype(np.uint64)
    h = np.concatenate([np.sort(a[:600]), np.sort(a[150:750])])
    values, sketch = nd.signatures(h, np.array([0, 600, 600, 1200]), 50, 8)
    assert abs((values[0] == values[2]).mean() - 450 / 750) < 0.08
    same = nd.agreeing(sketch[0], sketch[2], 400) / 400
    assert abs((same - 0.25) / 0.75 - 450 / 750) < 0.1


def test_packed_signatures_keep_the_order_of_prefixes():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 4, (300, 2, 8)).astype(np.uint16)
    order = nd.packed(values)
    for t in range(2):
        assert np.lexsort((order[:, t, 1], order[:, t, 0])).tolist() == sorted(range(300), key=lambda i: values[i, t].tolist())


def test_links_of_a_run_are_a_spanning_forest():
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 62, (6, 5)).astype(np.uint64)
    sketch = centre[rng.integers(0, 6, 700)] ^ (np.uint64(1) << rng.integers(0, 62, (700, 5)).astype(np.uint64))
    node = rng.permutation(700)
    a, b = nd.run_links(node, sketch, 150, 160)
    place = np.argsort(node)
    assert (nd.agreeing(sketch[place[a]], sketch[place[b]], 160) >= 150).all()
    near = nd.agreeing(sketch[:, None], sketch[None], 160) >= 150
    x, y = np.nonzero(near)
    want = dict(zip(*_graph.roots(node[x], node[y]), strict=True))
    got = dict(zip(*_graph.roots(np.append(a, node), np.append(b, node)), strict=True))
    assert got == want and len(a) == 700 - len(set(want.values()))


@pytest.mark.parametrize("clusters", [2, 50])
def test_a_run_that_partitions_cut_stays_whole(spark, clusters):
    """One trie, one run of 20,000 nodes over eight partitions: as many components as there are clusters."""
    rng = np.random.default_rng(clusters)
    kinds = []
    while len(kinds) < clusters:  # far from each other, also by the lower measure
        new = rng.integers(0, 4, 8)
        if all((new == k).sum() < 5 for k in kinds):
            kinds.append(new)
    n = 20_000
    own = np.arange(n) % clusters
    sketch = [int(sum(int(v) << (2 * i) for i, v in enumerate(kinds[c]))) for c in own]
    prefix = 0x1234_5678_9ABC_DEF0 >> 1
    rows = [(i, [prefix, 0x0F00_0000_0000_0000 + int(rng.integers(0, 1 << 40))], [s]) for i, s in enumerate(sketch)]
    nodes = spark.createDataFrame(rows, "n long, sig array<long>, sketch array<long>")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        links = nd._links(nodes, 1, 8, 5, 0.8).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    node, root = nd.roots(np.array([r.a for r in links]), np.array([r.b for r in links]))
    assert len(node) == n and len(set(root.tolist())) == clusters and len({(int(own[a]), int(own[b])) for a, b in zip(node, root, strict=True)}) == clusters


def test_unlike_nodes_of_a_run_are_split(monkeypatch):
    import time

    rng = np.random.default_rng(4)
    n = 16_000
    sketch = rng.integers(0, 1 << 63, (n, 5)).astype(np.uint64)
    sketch[:40] = sketch[0]  # one cluster among them
    deeper = rng.integers(0, 1 << 16, (n, 3)).astype(np.uint16)
    begin = time.process_time()
    a, b = nd.run_links(np.arange(n), sketch, 118, 160, deeper)
    assert time.process_time() - begin < 2
    node, root = nd.roots(a, b)
    assert set(node.tolist()) == set(range(40)) and set(root.tolist()) == {0}
    # Those that share the next levels are still compared.
    monkeypatch.setattr(nd, "LARGE", 100)
    monkeypatch.setattr(nd, "TREES_AT_ONCE", 2)
    sketch[8000:8004], deeper[8000:8004] = sketch[8000], deeper[8000]
    a, b = nd.run_links(np.arange(n), sketch, 118, 160, deeper)
    assert {frozenset((8000, 8000 + i)) for i in (1, 2, 3)} <= {frozenset(x) for x in zip(a.tolist(), b.tolist(), strict=True)}


def test_alike_nodes_among_thousands_of_unlike_ones_are_linked():
    """Of a large run no pair is left out, also where the next levels differ."""
    rng = np.random.default_rng(6)
    n = 6000
    sketch = rng.integers(0, 1 << 63, (n, 5)).astype(np.uint64)
    sketch[[5000, 5900]] = sketch[4000]
    deeper = rng.integers(0, 1 << 16, (n, 3)).astype(np.uint16)
    for more in ((deeper,), ()):
        a, b = nd.run_links(np.arange(n), sketch, 118, 160, *more)
        assert set(a.tolist()) | set(b.tolist()) == {4000, 5000, 5900} and len(a) == 2


@pytest.mark.parametrize("large", [1 << 15, 300])
def test_trees_that_partitions_cut_meet_by_all_their_nodes(spark, monkeypatch, large):
    """One run whose halves are chains: only nodes that begin no tree are like some of the other half."""
    monkeypatch.setattr(nd, "LARGE", large)
    # Of eight values the first k differ, so 6 of 8 agree with those two steps away.
    chain = [sum(1 << (2 * i) for i in range(k)) for k in range(0, 9, 2)]
    own = [(0, 1, 2)[i % 3] if i < 500 else (4, 3)[i % 2] for i in range(1000)]
    first = {k: 1000 * at for at, k in enumerate((0, 1, 2, 4, 3))}  # each tree begins with a node at the far end of its chain
    nodes = spark.createDataFrame([(first[k] + i, [0x1234_5678_9ABC, 0x0F00_0000_0000_0000 + i], [chain[k]]) for i, k in enumerate(own)], "n long, sig array<long>, sketch array<long>")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        links = nd._links(nodes, 1, 8, 5, 0.8).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    node, root = nd.roots(np.array([r.a for r in links]), np.array([r.b for r in links]))
    assert len(node) == 1000 and set(root.tolist()) == {0}


def test_unpacked_values():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 16, (30, 2, 8)).astype(np.uint16)
    both = nd.packed(values).view(np.int64)
    for begin in (0, 3, 5, 8):
        assert (nd.unpacked(both[:, 1, 0].copy(), both[:, 1, 1].copy(), begin, 8) == values[:, 1, begin:]).all()


@pytest.mark.parametrize("local", [1 << 20, 3])
@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (5, 4), (7, 7)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)] + [(100, 101), (39, 100)]])
def test_components(spark, edges, local):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {(r.node, r.component) for r in _graph.components(df, local).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {(x, find(x)) for x in list(root)}


def test_phrases_cover_all_windows():
    import pyarrow as pa

    w = _text.words(pa.array([" ".join(f"v{i % 37}" for i in range(300)), "few words", " ".join("same" for _ in range(80))]))
    row, _, _, start, size = sd.phrases(w)
    assert [int(size[row == r].sum()) for r in range(3)] == [251, 0, 31]


@pytest.mark.parametrize("n, reach", [(5, 5), (40, 7), (1000, 39), (140_000, 39)])
def test_leftmost_least(n, reach):
    g = np.random.default_rng(n).integers(0, 50 if n < 1000 else 1 << 62, n).astype(np.uint64) << np.uint64(16)
    view = np.lib.stride_tricks.sliding_window_view(g, reach)
    assert (sd._leftmost_least(g, reach) == view.argmin(1) + np.arange(n - reach + 1)).all()


def slow_factors(rows, width):
    """Parses each text from left to right: a factor goes on as long as the first occurrences of its windows follow each other."""
    place = {}
    for i, t in sorted((i, t or "") for i, t in rows):
        w = t.split()
        for k in range(len(w) - width + 1):
            place.setdefault(tuple(w[k : k + width]), (i, k))
    out = set()
    for i, t in rows:
        w, begin, before = (t or "").split(), None, None
        for k in range(len(w) - width + 2):
            at = place.get(tuple(w[k : k + width])) if k + width <= len(w) else None
            at = at if at and at[0] < i else None
            if begin is not None and (at is None or at != (before[0], before[1] + 1)):
                out.add((i, begin[0], k - 1 - begin[0] + width, *begin[1]))
                begin = None
            if at and begin is None:
                begin = (k, at)
            before = at
    return out


def test_factors_are_those_of_a_plain_parse(spark):
    """Two sources and a text of passages of both: where one source ends, the next factor begins."""
    v = [f"v{i}" for i in range(300)]
    first, second = " ".join(v[:120]), " ".join(["x"] * 3 + v[100:260])
    rows = [(1, first), (2, second), (3, " ".join(["y", *v[20:110], "z", *v[130:230], "q"])), (4, " ".join(v[:260]))]
    got = {(r.doc_id, r.start, r.words, r.source_id, r.source_start) for r in sd.factors(frame(spark, rows)).collect()}
    assert got == slow_factors(rows, 50)
    assert (3, 1, 90, 1, 20) in got and (3, 92, 100, 2, 33) in got


def test_factors_are_copies_of_their_sources(spark):
    rows = [(i, t) for i, t in ordinary(7, 80)]
    words = {i: t.split() for i, t in rows}
    got = sd.factors(frame(spark, rows), 12, 5).collect()
    assert got and all(r.source_id < r.doc_id and r.words >= 12 for r in got)
    assert all(words[r.doc_id][r.start : r.start + r.words] == words[r.source_id][r.source_start : r.source_start + r.words] for r in got)


def test_a_line_that_comes_a_hundred_times(spark):
    """Repetitions within a text are one row of the index, and what goes is that of brute force."""
    import pyarrow as pa

    rows = [(i, f"head {i} " + " ".join(f"u{i}x{k}" for k in range(i % 9)) + " is onhe now" * (30 + 5 * (i % 4)) + f" tail {i} " + "same " * 70 + f"end {i}") for i in range(20)]
    assert sorted(map(tuple, sd.substring_digests(frame(spark, rows)).collect()), key=str) == kept(rows, 50)
    words = {i: t.split() for i, t in rows}
    got = sd.factors(frame(spark, rows)).collect()
    assert got and all(words[r.doc_id][r.start : r.start + r.words] == words[r.source_id][r.source_start : r.source_start + r.words] for r in got)
    row, anchor, phrase, start, size = sd.phrases(_text.words(pa.array(["is onhe now " * 500])))
    first, times = sd.repeated(row, phrase, start, size)
    assert len(row) > 400 and len(first) < 5 and int((size[first] * times).sum()) == int(size.sum()) == 1451


def test_one_row_that_comes_often_and_a_source_that_is_everywhere(spark):
    passage = " ".join(f"p{i}" for i in range(90))
    rows = [(7, f"often {passage}")] * 200 + [(100 + i, f"{i} a{i} {passage} b{i}") for i in range(300)] + [(1, passage)]
    assert sorted(map(tuple, sd.substring_digests(frame(spark, rows)).collect()), key=str) == kept(rows, 50)


def test_a_large_group_of_near_copies_is_counted_whole(spark):
    """Over several blocks: every node is linked to every other one, and the group is one class."""
    rows = spark.range(6000).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(0, 199), i -> if(i = id % 200, concat('x', id), if(i = id * 7 % 200, concat('y', id), concat('b', i))))) as text")
    got = nd.near_duplicates(rows).groupBy("class_id", "n_links").count().collect()
    assert [tuple(r) for r in got] == [(0, 5999, 6000)]


def edited_pairs(n, words=64):
    """Pairs of texts of which one has other words at its end, of similarity about the threshold; and a line that all have."""
    line = " ".join(f"often{k}" for k in range(12))
    out = []
    for i in range(n):
        base = [f"w{i}x{k}" for k in range(words)]
        out += [(2 * i, " ".join([line, *base])), (2 * i + 1, " ".join([line, *base[: words - 6 - i % 5], *(f"e{i}x{k}" for k in range(6 + i % 5))]))]
    return out


@pytest.mark.parametrize("sharing", [4096, 5])
def test_links_that_the_forest_misses_are_found(spark, monkeypatch, sharing):
    """One trie misses many pairs right at the threshold; all links are those of brute force, also where a shingle that no order puts last is dealt in blocks."""
    monkeypatch.setattr(nd, "SHARING", sharing)
    if sharing == 5:
        monkeypatch.setattr(nd, "FREQUENT", 0)
    rows = edited_pairs(80) + [(1000 + i, f"{t} tail{i}") for i, (_, t) in enumerate(near_copies(20, 70))]
    expected = classes(rows)
    assert 40 < sum(n for i, _, n in expected if i < 1000) < 160
    got = nd.near_duplicates(frame(spark, rows), trees=1)
    assert sorted(map(tuple, got.collect()), key=str) == expected


def test_links_that_a_sample_does_not_show_are_found(spark, monkeypatch):
    """The whole depth, as a sample of closer copies asks for, misses a pair at the threshold with 0.025."""
    monkeypatch.setattr(nd, "matched_depth", lambda nodes, n, threshold, recall, trees, depth: depth)
    rows = [(i, t) for i, t in edited_pairs(800) if i // 2 % 5 == 2]
    stay = nd.one_of_each(frame(spark, rows)).count()
    assert stay == len({c for _, c, _ in classes(rows)})


def test_parities_and_prefixes_bound_what_sets_share():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    h = [np.unique(rng.choice(base[: 20 + 40 * (i % 9)], 12 + 30 * (i % 9), replace=False)) for i in range(40)] + [np.zeros(0, np.uint64), np.unique(base)]
    h += [np.unique(np.concatenate([x[: int(len(x) * 0.9)], rng.integers(0, 1 << 63, 1 + len(x) // 12).astype(np.uint64)])) for x in h]
    off = np.concatenate([[0], np.cumsum([len(x) for x in h])])
    bits, wide, start = nd.parities(np.concatenate(h), off)
    assert [len(x) <= 64 * (start[i + 1] - start[i]) for i, x in enumerate(h)] == [True] * len(h)
    assert all((np.bitwise_xor.reduce(wide[start[i] : start[i + 1]].reshape(-1, nd.PARITY)) == bits[i]).all() for i in range(len(h)))
    often = np.sort(base[:50])
    first, at = nd.prefixes(np.concatenate(h), off, 0.8, often, np.arange(50) + 2)
    near = 0
    assert len(set(np.diff(start).tolist())) > 1
    for i, x in enumerate(h):
        for j, y in enumerate(h[:i]):
            common = len(np.intersect1d(x, y))
            assert int(np.bitwise_count(bits[i] ^ bits[j]).sum()) <= len(x) + len(y) - 2 * common
            if common and common >= 0.8 * (len(x) + len(y) - common) - 1e-6:
                near += 1
                assert len(np.intersect1d(first[at[i] : at[i + 1]], first[at[j] : at[j + 1]]))
    assert near > 10


def test_a_long_text_and_a_longer_one_that_the_forest_misses(spark, monkeypatch):
    """Sets that differ in their numbers of parity bits; nothing comes from the forest."""
    monkeypatch.setattr(nd, "_links", lambda nodes, *_: nodes.select(nodes.n.alias("a"), nodes.n.alias("b")))
    rows = []
    for i in range(6):
        base = [f"w{i}x{k}" for k in range(900)]
        rows += [(3 * i, " ".join(base)), (3 * i + 1, " ".join([*base, *(f"e{i}x{k}" for k in range(200 + 9 * i))])), (3 * i + 2, " ".join([*base[:300], *(f"f{i}x{k}" for k in range(700))]))]
    expected = classes(rows)
    assert 0 < sum(n for _, _, n in expected) < 12
    assert sorted(map(tuple, nd.near_duplicates(frame(spark, rows)).collect()), key=str) == expected


def long_words(n, words=40):
    """Unlike texts of long words that do not compress, and two that are alike."""
    rng = random.Random(9)
    letters = string.ascii_letters + string.digits + "-_"
    rows = [(i, " ".join("".join(rng.choices(letters, k=200)) for _ in range(words))) for i in range(n)]
    return [*rows, (n, f"{rows[0][1]} more")]


def test_texts_that_nothing_asks_for_are_not_sent(spark):
    """Of documents that are like no other, exchanges carry signatures and prefixes, not texts."""
    rows = long_words(320)
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)

    def sent():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, none, spark.sparkContext._jvm.java.util.ArrayList())
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}

    df = spark.createDataFrame(rows, "doc_id long, text string")
    before = sent()
    got = {r.doc_id: (r.class_id, r.n_links) for r in nd.near_duplicates(df).collect()}
    assert got == {i: (0, 1) if i in (0, 320) else (i, 0) for i, _ in rows}
    # One in ORDERED_BY texts is sent for the order of shingles.
    assert sum(v for k, v in sent().items() if k not in before) < 0.6 * sum(len(t) for _, t in rows)


def test_among_leaves_out_nothing_that_is_wanted(spark, monkeypatch):
    rows = [(None if i % 7 == 0 else i - 50, (i * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, tag long")
    wanted = [rows[i] for i in range(0, 2000, 9)]
    asked = spark.createDataFrame(wanted, "_id long, tag long")
    for size, most in ((64, 2000), (1 << 24, 240)):
        monkeypatch.setattr(nd, "FILTER", size)
        got = nd._among(docs, asked).collect()
        assert set(wanted) <= {tuple(r) for r in got} <= set(rows) and len(wanted) <= len(got) <= most
        assert nd._among(docs, asked.limit(0)).count() == 0


def test_wide_columns_are_held_once(spark, monkeypatch):
    """While shingles are dealt, one table has the prefixes, and none the signatures; at the end there is neither."""
    made, held = [], []
    alive = lambda: [t.columns for t in made if os.path.exists(t._gleaner_path.removeprefix("file:"))]

    def cut(df):
        out = _spark.cut(df)
        if out.columns == ["t", "n", "c"]:
            held.extend(alive())
        made.append(out)
        return out

    monkeypatch.setattr(nd, "cut", cut)
    rows = edited_pairs(80)
    got = nd.near_duplicates(frame(spark, rows), trees=1)
    assert sorted(map(tuple, got.collect()), key=str) == classes(rows)
    assert sum("prefix" in c for c in held) == 1 and not any("sig" in c for c in held)
    assert not any({"prefix", "sig", "shingles"} & set(c) for c in alive())
