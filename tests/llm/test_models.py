import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from gleaner.llm import language_id as li, quality
from tests.conftest import SMALL
from tests.llm.corpus import AWKWARD, frame

SYLLABLES = {"xx": ["ba", "ko", "ri"], "yy": ["sch", "ung", "ei"], "zz": ["ão", "çe", "lh"]}


def speech(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(2)
    labels = [lang for lang in SYLLABLES for _ in range(40)]
    return li.train([speech(lang, 50, rng) for lang in labels], labels, steps=25)


def test_posteriors_are_forward_backward(model):
    rng = np.random.default_rng(0)
    m = li.Model(["a", "b", "c"], None, rng.normal(size=(3, 3)), rng.normal(size=3), None)
    for n in (1, 2, 127, 128, 129, 700, 1500):
        e = (rng.normal(size=(n, 3)) * 2).astype(np.float32)
        fresh = rng.random(n) < (0.02 if n % 2 else 0.002)
        fresh[0] = True
        got, edges = li.posteriors(e.copy(), fresh, m), [*np.flatnonzero(fresh), n]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            assert np.abs(got[a:b] - li._forward_backward(e[None, a:b].astype(float), m.move, m.start)[0][0]).max() < 1e-5


def test_forward_backward_sums_over_all_paths():
    import itertools

    rng = np.random.default_rng(1)
    e, move, start = rng.normal(size=(1, 4, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    mass = np.zeros((4, 2))
    for path in itertools.product(range(2), repeat=4):
        p = np.exp(start[path[0]] + sum(e[0, t, s] for t, s in enumerate(path)) + sum(move[a, b] for a, b in zip(path[:-1], path[1:], strict=True)))
        for t, s in enumerate(path):
            mass[t, s] += p
    assert np.allclose(li._forward_backward(e, move, start)[0][0], mass / mass.sum(1, keepdims=True))


def test_code_switched_words_are_labelled(model):
    rng = random.Random(8)
    text = speech("xx", 12, rng) + " " + speech("yy", 12, rng)
    w = li.T.words(pa.array([text]))
    which, code = li.distinct(w)
    fresh = np.zeros(w.n, bool)
    fresh[0] = True
    best = li.posteriors(li.word_weights(w, which, model)[code], fresh, model).argmax(1)
    truth = np.repeat([model.langs.index("xx"), model.langs.index("yy")], 12)
    assert (best == truth).mean() > 0.9


def test_prediction_does_not_depend_on_neighbours(model):
    rng = random.Random(4)
    texts = [speech(rng.choice(list(SYLLABLES)), rng.randint(1, 300), rng) for _ in range(20)] + [None, "", "12 !!", "é"]
    lang, score = li.predict(pa.array(texts, pa.string()), model)
    for t, a, s in zip(texts, lang, score, strict=True):
        (b,), (r,) = li.predict(pa.array([t], pa.string()), model)
        assert a == b and abs(s - r) < 1e-5 and 0 <= s <= 1
    assert lang[-4:-1] == ["und"] * 3 and lang[-1] != "und"


def test_language_id(spark):
    rng = random.Random(6)
    rows = [(i, speech(lang, rng.randint(1, 80), rng), lang) for i in range(300) for lang in [rng.choice(list(SYLLABLES))]]
    df = spark.createDataFrame([*rows, (900, None, "xx"), (901, "", None), (None, "ba ko", "xx"), (902, "123", "yy"), (902, "123", "yy")], "doc_id long, text string, lang string").selectExpr("*", "'x' as score", "'x' as held_out")
    got = li.language_id(df).collect()
    assert len(got) == 305
    truth = {i: lang for i, _, lang in rows}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert {r.lang_pred for r in got if r.doc_id in (900, 901, 902)} == {"und"}
    empty = li.language_id(df.limit(0)).collect()
    assert empty == []
    alone = li.language_id(df.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert len(alone) == 305 and {r.lang_pred for r in alone} == {"und"}


def test_language_id_on_the_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = li.language_id(docs).join(docs.selectExpr("doc_id", "lang", "n_chars"), "doc_id").where("held_out and n_chars > 40").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.95


def test_the_sample_is_bounded_by_language(spark, monkeypatch):
    """One row that comes often, many languages: no more than the parameters say reaches the driver."""
    rng = random.Random(1)
    rows = [(9, "always the very same words", "xx")] * 500 + [(1000 + i, speech("yy", 6, rng), "yy") for i in range(300)] + [(5000 + i, "a b c", f"l{i}") for i in range(60)]
    got = []
    monkeypatch.setattr(li, "train", lambda texts, labels: got.append((texts, labels)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    li.learn(df, held_out=9, per_lang=40)
    texts, labels = got[0]
    assert set(labels) == {"xx", "yy", *(f"l{i}" for i in range(60))} and labels.count("xx") == 1 and labels.count("yy") == 40
    li.learn(df, held_out=9, per_lang=40, most_rows=130)
    assert set(got[1][1]) == set(labels) and got[1][1].count("yy") == 2 and len(got[1][0]) <= 130
    monkeypatch.setattr(li, "MOST", 61)
    with pytest.raises(ValueError, match="61"):
        li.learn(df, held_out=9)


def test_texts_side_by_side_have_the_posteriors_of_a_chain(monkeypatch):
    rng, pick = np.random.default_rng(7), random.Random(7)
    k, size = 20, 1 << 10
    m = li.Model([f"l{i}" for i in range(k)], rng.normal(size=(size, k)).astype(np.float32) / 4, rng.normal(size=(k, k)), rng.normal(size=k), np.arange(size, dtype=np.int32))
    texts = [" ".join(pick.choice(["ba", "ko", "42", "été", "x-y", "--"]) for _ in range(n)) for n in (0, 1, 2, 127, 128, 129, 0, 700, 256, 5, 5, 1500)] + [None]
    monkeypatch.setattr(li, "BLOCK", 3 * li.SEGMENT * k)  # three texts at a time
    wide = li.predict(pa.array(texts, pa.string()), m)
    monkeypatch.setattr(li, "WIDE", 100)
    chain = li.predict(pa.array(texts, pa.string()), m)
    assert wide[0] == chain[0] and np.abs(np.array(wide[1]) - chain[1]).max() < 1e-5
    w = li.T.words(pa.array(texts[7:8]))
    which, code = li.distinct(w)
    post = li._forward_backward(li.word_weights(w, which, m)[code][None].astype(float), m.move, m.start)[0][0]
    assert np.abs(li.side_by_side(w, which, code, np.ones(w.n, bool), m)[0] - post.sum(0)).max() < 1e-2


def test_every_language_is_learned(spark):
    """More languages than a chain takes, the last of them rare."""
    rng = random.Random(12)
    sound = {f"l{i:02}": [chr(97 + i % 26) + v + chr(97 + (i * 7 + i // 26) % 26) for v in "aeiou"] for i in range(80)}
    say = lambda lang: " ".join("".join(rng.choice(sound[lang]) for _ in range(2)) for _ in range(30))
    rows = [(i, say(lang), lang) for i, lang in enumerate([*sound] * 6 + ["l00"] * 400)]
    got = li.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    truth = {i: lang for i, _, lang in rows}
    held = [r for r in got if r.held_out]
    assert len(got) == len(rows) and {r.lang_pred for r in got} == set(sound)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95


def test_few_weights_for_many_languages():
    assert li.table_size(4) == li.table_size(32) == li.FEATURES and all(k * li.table_size(k) <= li.TABLE < 2 * k * li.table_size(k) for k in (33, 64, 100, 1024))


def test_language_of_awkward_documents(spark, model):
    df = frame(spark, [*AWKWARD, (40, "ba ko ri " * 60_000)])
    got = {r.doc_id: r for r in li.identify(df, model).collect()}
    assert len(li.identify(df, model).collect()) == len(AWKWARD) + 1 and got[40].lang_pred == "xx" and got[40].score > 0.9
    assert {got[i].lang_pred for i in (1, 2, 3, 7)} == {"und"} and all(0 <= r.score <= 1 for r in got.values())
    kept = li.keep_identified(df, model, 0.0)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in li.identify(df, model).where("lang_pred <> 'und'").collect())


# ------------------------------------------------------------------ quality


def test_labelled_documents_count_once(spark):
    docs = spark.createDataFrame([(3, f"text {i % 7}") for i in range(200)] + [(6, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1), (6, 0), (3, 1)], "doc_id long, quality int")
    model = quality.learn(docs, labels, held_out=9)
    assert len(model.labels) == 2 and sorted(model.labels) == [0, 1]


def slow_terms(text):
    """Terms of one text, counted one by one."""
    out, raw = np.zeros(quality.TERMS + quality.EXTRA), text.encode()
    for i in range(len(raw) - 2):
        a, b, c = (int(quality._CLASS[x]) for x in raw[i : i + 3])
        out[quality.WORDS + quality._COLUMN[a << 12 | b << 6 | c]] += 1
    out[quality.WORDS : quality.TERMS] /= max(1, len(raw) - 2)
    words = raw.lower().split() if text.isascii() else [bytes(x + 32 if 65 <= x <= 90 else x for x in w) for w in raw.split()]
    for w in words:
        h = li.T.words(pa.array([w.decode()])).hashes(0, fold=True)[0]
        out[int(h % np.uint64(quality.WORDS))] += 1 / len(words)
    for k, lag in enumerate(quality.LAGS):
        out[quality.TERMS + k] = sum(a == b for a, b in zip(words, words[lag:], strict=False)) / max(1, len(words))
    return np.sqrt(out)


def test_terms_and_votes_match_a_plain_count():
    """Scores of a handful of texts, told without any blocks or columns of texts."""
    rng = random.Random(3)
    texts = [speech(rng.choice(list(SYLLABLES)), rng.randint(1, 40), rng) + rng.choice(["", " 123 !!!", " Ab Ab ab ab", "\n\n"]) for _ in range(40)] + ["", "ab", "été ÉTÉ x"]
    got, want = quality.term_counts(pa.array(texts)), np.array([slow_terms(t) for t in texts])
    assert np.abs(got - want).max() < 1e-5 and (quality.term_counts(pa.array(["ab"]))[0] == got[-2]).all()
    labels = np.array([i % 2 for i in range(len(texts))], float)
    model = quality.fit(got, labels, 8)
    project = lambda c: (c * model.idf) @ model.axes
    for i, score in enumerate(quality.vote(got, model, 5, 3)):
        own = project(want[i])
        cos = [float(own @ project(v) / np.linalg.norm(own) / np.linalg.norm(project(v))) if np.linalg.norm(project(v)) * np.linalg.norm(own) > 0 else 0.0 for v in want]
        near = sorted(cos, reverse=True)
        if near[4] - near[5] < 1e-4:  # neighbours that tie
            continue
        weight = [max(0.0, x) ** 3 if x >= near[4] - 1e-9 else 0.0 for x in cos]
        plain = sum(w * y for w, y in zip(weight, labels, strict=True)) / sum(weight) if sum(weight) else labels.mean()
        assert abs(score - plain) < 1e-3


def test_leading_axes():
    rng = np.random.default_rng(0)
    x = (rng.normal(size=(200, 6)) * [9, 7, 5, 3, 2, 1]) @ np.linalg.qr(rng.normal(size=(80, 6)))[0].T
    got, want = quality.leading_axes(x.astype(np.float32), 4), np.linalg.svd(x, full_matrices=False)[2][:4].T
    assert np.allclose(np.abs((got * want).sum(0)), 1, atol=1e-3)


def test_vote_is_exact():
    rng = np.random.default_rng(3)
    counts = rng.random((300, quality.TERMS + quality.EXTRA)).astype(np.float32)
    labels = (rng.random(300) < 0.5).astype(float)
    m = quality.fit(counts, labels, 10)
    got = quality.vote(counts[:50], m, 7, 4, block=16)
    v = m.project(counts)
    for i in range(50):
        cos = v @ v[i]
        near = np.argsort(-cos)[:7]
        weight = np.maximum(cos[near], 0).astype(float) ** 4
        assert abs(got[i] - (weight * labels[near]).sum() / weight.sum()) < 1e-4


def test_quality_on_the_tables(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    got = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert got and sum(r.predicted == r.quality for r in got) / len(got) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_quality_of_awkward_documents(spark):
    df = frame(spark, AWKWARD)
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (9, 1, None), (6, 0, 1), (99, 1, 1), (None, 1, 1), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(df, labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.quality_scores(df, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(df.limit(0), labels).count() == 0


def test_repetition_is_seen():
    plain = quality.term_counts(pa.array(["a b c d e f g h", "a a a a a a a a", None, "x"]))
    assert plain[1, quality.TERMS] > 0.8 > plain[0, quality.TERMS] and not plain[2].any()
