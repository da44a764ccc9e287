import random
import time

import numpy as np
import pytest

from gleaner.llm import html_extract, vector_search as vs
from gleaner.llm.html_extract import extract, main_text
from gleaner.llm.queries import op1_vector_search
from tests.conftest import SMALL


def exact(ids, v, asked, k):
    n = v / np.sqrt((v * v).sum(1))[:, None]
    out = {}
    for q in asked:
        i = int(np.flatnonzero(ids == q)[0])
        score = n @ n[i]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def recall(got, truth, k=5):
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by) == set(truth) and all(len(x) == k for x in by.values())
    assert all([s for _, s in x] == sorted((s for _, s in x), reverse=True) for x in by.values())
    exact_score = {(q, j): s for q in truth for j, s in truth[q]}
    assert all(abs(s - exact_score[q, i]) < 1e-12 for q in by for i, s in by[q] if (q, i) in exact_score)
    return sum(len({i for i, _ in by[q]} & {i for i, _ in truth[q]}) for q in truth) / (k * len(truth))


def test_recall(spark):
    rng = np.random.default_rng(7)
    v = (rng.normal(size=(2000, 32)) + 2 * rng.normal(size=(12, 32))[rng.integers(0, 12, 2000)]).astype(np.float32)
    rows = [(i, [float(x) for x in v[i]]) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    truth = exact(np.arange(2000), v.astype(float), range(0, 2000, 50), 5)
    assert recall(vs.nearest(df, df.where("vec_id % 50 = 0")).collect(), truth) >= 0.9
    # Many shards and blocks of queries: the same contract.
    assert recall(vs.nearest(df, df.where("vec_id % 50 = 0"), cell=640).collect(), truth) >= 0.9


def test_recall_on_the_tables(spark):
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SMALL}/embeddings.parquet").combine_chunks()
    (dim, (ids, v)), *_ = vs.matrix(t.column("vec_id").combine_chunks(), t.column("embedding").combine_chunks()).items()
    got = op1_vector_search(spark, SMALL).collect()
    truth = exact(ids, v, [int(i) for i in ids if i % 50 == 0], 5)
    assert dim == 64 and recall(got, truth) >= 0.9


def test_probing_finds_every_code_in_reach():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 40, (3000, 2)).astype(np.uint64)
    codes[::3] = codes[0] ^ (np.uint64(1) << rng.integers(0, 40, (1000, 2)).astype(np.uint64))
    index = vs.Index(codes, [[14, 13, 13], [20, 20]])
    for radius in (0, 1, 2, 3, 7, 12, 20, 35, 80):
        q, row = index.within(codes[:20], radius)
        want = np.nonzero(np.bitwise_count(codes[:20, None] ^ codes[None]).sum(2) <= radius)
        assert q.tolist() == want[0].tolist() and row.tolist() == want[1].tolist()


def test_a_large_shard_is_searched_in_blocks(spark):
    """One cell of many rows and of more queries than are probed at once."""
    df = spark.range(60_000).selectExpr("id as vec_id", "transform(sequence(1, 8), x -> cast(sin(id * x) as float)) as embedding")
    got = vs.nearest(df, df.where("vec_id % 200 = 0"), cell=1 << 30).collect()
    assert len(got) == 299 * 5  # sin 0 makes one zero vector
    assert all(r.vec_id != r.query_id and r.score > 0.9 for r in got)


def test_each_length_of_vectors_is_searched(spark):
    df = spark.range(300).selectExpr("id as vec_id", "transform(sequence(1, if(id % 3 = 0, 8, 5)), x -> cos(id * x)) as embedding")
    got = vs.nearest(df, df.where("vec_id % 50 = 0")).collect()
    assert len(got) == 6 * 5 and all((r.query_id % 3 == 0) == (r.vec_id % 3 == 0) for r in got)


def test_a_row_that_comes_often(spark):
    df = spark.range(3000).selectExpr("if(id < 1000, 7, id) as vec_id", "if(id < 1000, array(1f, 2f, 3f), array(cast(id as float), 1f, cast(sin(id) as float))) as embedding")
    got = vs.nearest(df, df.where("vec_id % 50 = 0")).collect()
    assert len(got) == 40 * 5 and len({(r.query_id, r.vec_id) for r in got}) == len(got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]), (1, [1.0, 0.1, 0.0]), (2, [2.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 0.0]), (6, [nan, 1.0, 1.0]),
        (7, [inf, 1.0, 1.0]), (8, [1.0, 2.0]), (9, []), (None, [1.0, 0.0, 0.0]), (10, [1.0, 0.0, 0.0]), (100, [0.0, 0.0, 1.0]), (50, [-1.0, 0.0, 0.0]), (150, None),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as rank", "'x' as score")
    got = {}
    for r in vs.nearest(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got[0] == [2, 10, 1, 100, 50] and len(got[50]) == len(got[100]) == 5 and set(got) == {0, 50, 100}
    assert vs.nearest(df.limit(0), df.limit(0)).count() == 0 and vs.nearest(df.where("vec_id = 3"), df).count() == 0
    few = df.where("vec_id in (0, 1)")
    assert [(r.query_id, r.vec_id) for r in vs.nearest(few, few.where("vec_id = 0")).collect()] == [(0, 1)]


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e308, 5e-324])
def test_very_large_and_very_small_vectors(spark, size):
    rows = [(i, [size * (x if size > 1e-300 else round(x)) for x in (1.0, 0.1 * i)]) for i in range(8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vs.nearest(df, df.where("vec_id = 0"), k=3).orderBy("rank").collect()
    want = sorted(((-float(np.dot(vs.unit(np.array([rows[0][1]]))[0], vs.unit(np.array([v]))[0])), i) for i, v in rows[1:]))[:3]
    assert all(np.isfinite(r.score) for r in got) and np.allclose([r.score for r in got], [-s for s, _ in want]) and [r.vec_id for r in got] == [i for _, i in want]


def test_equal_vectors_go_by_id(spark):
    df = spark.range(400).selectExpr("id as vec_id", "array(1.5f, 2.5f) as embedding")
    got = vs.nearest(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got if r.query_id == 0] == [1, 2, 3, 4, 5] and [r.vec_id for r in got if r.query_id == 350] == [0, 1, 2, 3, 4]


LONG = "A sentence, with commas, that is long enough to count, as the text of an article should be, one would think."


@pytest.mark.parametrize(
    "html, want",
    [
        (None, ""), ("", ""), ("just text", "just text"), ("<script>var a = '<p>x</p>'</script><style>p{}</style>", ""), ("<nav><a href=/>Home</a></nav>", ""),
        (f"<nav><a>Menu</a></nav><article><h1>T &amp; t</h1><p><b>{LONG}<br><p>Short.</p></article><footer>f</footer>", f"T & t\n{LONG}\nShort."),
        (f"<div class=sidebar><p>{LONG} {LONG}</p></div><div id=main><p>{LONG}</p><p>a&nbsp; \n b</p><form><p>Your mail</p></form></div>", f"{LONG}\na b"),
        (f"<body><header><h1>Site</h1></header><div class='cookie-notice'><p>{LONG}</p></div><article><header><h1>Head</h1></header><p>{LONG}</p><aside>{LONG}</aside><div class=ad>{LONG}</div></article>"
         f"<section class=comments><article><p>{LONG} {LONG} {LONG}</p></article></section>", f"Head\n{LONG}"),
        (f"<table><tr><td><a href=/1>one, two, three, four, five, six, seven, eight</a></td></tr></table><div><p>{LONG}</p></div>", LONG),
        (f"<article><p>{LONG}", LONG), (f"<article><p>{LONG}<a hre", LONG), ("<article><p>Short &lt;b&gt; &#233;&#x1F642; &unknown; x</article>", "Short <b> é🙂 &unknown; x"),
        (f"<article><ul><li>a<li>b</ul><p>{LONG}</p><pre>x\n  y</pre></article>", f"a\nb\n{LONG}\nx y"),
        (f"<article><p>{LONG}</p><p hidden>no</p><p style='display: none'>no</p><!-- <p>no</p> --></article>", LONG),
    ],
)
def test_extract(html, want):
    assert extract(html) == want


def test_siblings_of_a_div_layout():
    html = f"<div><div class=x><p>{LONG}</p><p>{LONG}</p></div><p>{LONG}</p><p><a href=/>{LONG}</a></p></div>"
    assert extract(html) == "\n".join([LONG] * 3)


def test_main_text(spark):
    df = spark.createDataFrame([(1, "u", f"<article><p>{LONG}</article>"), (1, "u", None), (None, None, "x" * 300_000), (2, "v", "<p>é</p>")], "page_id long, url string, html string").selectExpr("*", "'z' as text", "1 as n_chars")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in main_text(df).collect()), key=str)
    assert got == sorted([(1, "u", LONG, len(LONG)), (1, "u", "", 0), (None, None, "x" * 300_000, 300_000), (2, "v", "é", 1)], key=str)
    assert main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<article><p>A share of <span class='share'>ten percent</span> was sold, {LONG}</p></article>", f"A share of ten percent was sold, {LONG}"),
        (f"<article><div class='post-header'><h2>Sub</h2></div><p>{LONG}</p><div class=header>In</div></article><div class=header>Site</div>", f"Sub\n{LONG}\nIn"),
        (f"<div class=post><div class='entry-header'><h2 class=promo>Sub</h2></div><p class=notice>{LONG}</p></div><div class=masthead><p>{LONG}</p></div>", f"Sub\n{LONG}"),
        (f"<article><p>{LONG} &am<b>p;</b> &lt<i>;</i> &amp;lt;</article>", f"{LONG} &amp; <; &lt;"),
        (f"<article><p>{LONG}<p><i>a<b>b</i>c</b><div>d</article>", f"{LONG}\nabc\nd"),
        (f"<article><ul><li><p>a<li>b<ul><li>c</ul>d</ul><p>{LONG}</article>", f"a\nb\nc\nd\n{LONG}"),
    ],
)
def test_no_word_of_the_article_is_lost(html, want):
    assert extract(html) == want


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<article><p>{LONG}</p><h2 id='discussion'>Discussion</h2><p>{LONG}</p></article>", f"{LONG}\nDiscussion\n{LONG}"),
        (f"<article><p>{LONG}</p><section id='discussion'><h2>Discussion</h2><p>{LONG}</p><p>{LONG}</p></section></article>", f"{LONG}\nDiscussion\n{LONG}\n{LONG}"),
        (f"<article><p>{LONG}</p><p class='reply'>The reply came late.</p></article>", f"{LONG}\nThe reply came late."),
        (f"<article><p>{LONG}</p><section class='side-effects'><p>Few were seen.</p></section></article>", f"{LONG}\nFew were seen."),
        (f"<article><p>{LONG}</p><div class='popular-science'>Short.</div><div class='search-engines'>So.</div><ul id=relatedWork><li>x</ul></article>", f"{LONG}\nShort.\nSo.\nx"),
        (f"<article><p>{LONG}</p><textarea><p>inner</textarea> y</article>", f"{LONG}\ny"),
        (f"<article><p>{LONG}</p><textarea>a</b><p>inner", LONG),
        (f"<article><p>{LONG}</p><div class=share><a href=/>one</a> <a href=/>two</a></div><div class='related-articles'><h3>Related</h3><ul><li><a href=/>{LONG}</a></ul></div></article>", LONG),
        (f"<article><p>{LONG}</p><div class='comment-list'><p>{LONG}</p></div><div class=sideBar>{LONG}</div><div class='ad-box-1'>{LONG}</div><div class=replies><div>Nice one</div><div>Thanks</div></div></article>", LONG),
        (f"<div class='post'><p>{LONG}</p><section id=feedback><p>{LONG}</p></section></div><article class=comment><p>{LONG} {LONG}</p></article>", f"{LONG}\n{LONG}"),
    ],
)
def test_names_of_an_article_s_own_parts(html, want):
    assert extract(html) == want


def plain_out(page):
    """Which elements are left out, told by walking up from each; of unsure ones by their text, gathered by walking too."""
    above = [[] for _ in page.tag]
    for i in range(1, len(page.tag)):
        above[i] = [i, *above[page.parent[i]]]
    return above


@pytest.mark.parametrize("seed", range(6))
def test_what_is_left_out_matches_a_plain_walk(seed):
    rng = random.Random(seed)
    kinds = ["", "comment", "comments-area", "discussion", "side-effects", "popular", "adBox", "share-bar", "content", "post related", "notice", "x ad"]
    html = []
    for _ in range(300):
        t = rng.choice("div p section article li ul aside h2 form header span".split())
        name = rng.choice(kinds)
        html.append(rng.choice([f"<{t} class='{name}'>", f"<{t} id='{name}'>", f"</{t}>", "some text " * rng.randrange(1, 14), f"<a href=/>{'link ' * rng.randrange(1, 9)}</a>"]))
    whole = "".join(html)
    unsure = html_extract.UNSURE
    try:
        html_extract.UNSURE = frozenset()  # all that is not left out by its name alone
        page = html_extract.read(whole)
    finally:
        html_extract.UNSURE = unsure
    decided = html_extract.read(whole)
    above = plain_out(decided)
    gone = set()
    for i in decided.unsure:
        own = [b for b in page.blocks if i in above[b[0]]]
        texts = [len(t) for o, t, _ in own if page.tag[o] not in html_extract.HEADINGS]
        if sum(b[2] for b in own) > html_extract.LINKED * sum(len(b[1]) for b in own) or sum(texts) < html_extract.SHORT * len(texts):
            gone.add(i)
    assert decided.blocks == [b for b in page.blocks if not gone & set(above[b[0]])]


def slow_points(page):
    """Scores and sums by walking up from every block."""
    score, length, linked = {}, [0] * len(page.tag), [0] * len(page.tag)
    for owner, text, link in page.blocks:
        above = [owner]
        while page.parent[above[-1]] >= 0:
            above.append(page.parent[above[-1]])
        for i in above:
            length[i] += len(text)
            linked[i] += link
        boxes = [i for i in above if i and page.tag[i] in html_extract.CONTAINER]
        if len(text) >= 25 and page.tag[owner] not in html_extract.HEADINGS:
            for i, share in zip(boxes, html_extract.SHARES, strict=False):
                score.setdefault(i, []).append((1 + text.count(",") + min(len(text) // 100, 3)) * (1 - link / len(text)) * share)
    return {i: (html_extract.BASE.get(page.tag[i], 0) + sum(x)) * (1 - linked[i] / max(1, length[i])) for i, x in score.items()}, length, linked


@pytest.mark.parametrize("seed", range(8))
def test_scores_match_a_plain_walk(seed):
    rng = random.Random(seed)
    html = []
    for _ in range(400):
        t = rng.choice("div p section article li ul td table tr span a b h2 blockquote".split())
        html.append(rng.choice([f"<{t}>", f"<{t}>", f"</{t}>", "some, text " * rng.randrange(12), f"<a href=/>{'link ' * rng.randrange(5)}</a>", "<br>"]))
    page = html_extract.read("".join(html))
    score, length, linked = html_extract.points(page)
    want, *sums = slow_points(page)
    assert [length, linked] == sums and score.keys() == want.keys()
    assert all(abs(score[i] - want[i]) < 1e-9 for i in want)
    open_rule = [page.parent[i] < i for i in range(1, len(page.tag))]
    assert all(open_rule) and page.open[0] == 0


@pytest.mark.parametrize(
    "html, want",
    [
        ("<div>" * 50_000 + LONG + "</div>" * 50_000, LONG), ("<p>" * 50_000 + LONG, LONG), ("<span>" * 50_000 + LONG + "</div>" * 50_000, LONG), ("<span><div>" * 25_000 + LONG, LONG),
        ("<div>x" * 50_000, None), ("<ul><li>" * 25_000 + LONG, LONG), ("</b>" * 50_000 + LONG, LONG), ("<b><div></b>" * 20_000 + LONG, LONG), ("<!--" * 50_000 + LONG, ""), ("<" * 50_000 + LONG, None),
    ],
)
def test_deep_and_wide_pages_take_linear_time(html, want):
    begin = time.process_time()
    got = extract(html)
    assert time.process_time() - begin < 3
    assert want is None or got.endswith(want)
