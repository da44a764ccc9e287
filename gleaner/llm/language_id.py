"""Language identification by a linear-chain conditional random field over words.

Each word has features: byte n-grams within its boundary marks (those that hold a
mark are its affixes) and itself, all hashed into one table of weights per
language; the learned weights of whole words are the lexicon.  Learned transitions join neighbouring words.
Forward-backward gives each word's posterior over the languages, so code-switched
text is labelled word by word; a document's language is the one with the largest
sum of posteriors over the words with a letter, its score that sum's share.

Training: every language is learned, from a bounded sample of labelled documents: at most
``PER_LANG`` windows of each language and about ``ROWS`` in all, one at least of each, of at
most ``WINDOW`` words, one for a document, chosen by hashes.  Documents that come often count
once.  Half of the training sequences are spliced from windows of several languages, which
teaches the transitions both staying and switching.  The likelihood is maximised by gradient
steps on the driver, over the features that the sample has; others have no weight.  The model
goes to the executors: at most ``TABLE`` weights, for which many languages share a smaller
table of hashed features, and the transitions.  Transitions grow with the square of the
languages, so more than ``MOST`` are an error; none is left out.

Exactness at any length: with few languages, all words of a slice are one chain, in which a
document's first word resets the state.  The chain is cut into equal segments whose transfer
matrices are multiplied out in parallel and joined afterwards, so a very long document costs
no more per word than a short one.  Matrices for each segment cost the cube of the number of
languages, so with more than ``WIDE`` of them many documents go word by word side by side
instead, for the square; of the states at the words, only those at the segments' first words
and those of one segment are held.  Both give the same posteriors.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
prediction uses the text alone; repeated rows each give a row; without any labelled
document all texts are ``und``; an empty table gives an empty result; other columns
are ignored, or kept by ``keep_identified``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from . import _text as T
from ._spark import fold_of

PER_LANG, ROWS, WINDOW, STEPS = 400, 4096, 64, 40
#: Words of a training sequence, hashed features, words of an inference segment.
SEQUENCE, FEATURES, SEGMENT = 48, 1 << 18, 128
#: Weights of a model, languages that one driver can learn.
TABLE, MOST = 1 << 23, 1024
#: Languages from which on documents go side by side; numbers in a block of states.
WIDE, BLOCK = 16, 1 << 21
NGRAMS = (2, 3, 4)
UNKNOWN = "und"


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # (rows, languages); those of row 0, of features that were never seen, are 0
    move: np.ndarray  # log transition weights, from row to column
    start: np.ndarray
    slot: np.ndarray | None  # the row of each hashed feature's weights


def distinct(w: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words (as positions of one occurrence each) and each word's number among them."""
    _, first, code = np.unique(w.hashes(), return_index=True, return_inverse=True)
    return first, code


def features(w: T.Words, which: np.ndarray, size: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Features of some words, hashed to a table of the given size (a power of two): one flat array and the offsets of each word's."""
    length = w.end[which] - w.start[which]
    off = np.concatenate([[0], np.cumsum(length + 2)])
    # Each word between two marks, one after another.
    flat = np.full(off[-1], 2, np.uint64)
    inside = np.repeat(off[:-1] + 1 - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
    flat[inside] = w.data[np.repeat(w.start[which] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())]
    flat[off[1:] - 1] = 3
    owner = np.repeat(np.arange(len(which)), length + 2)
    left = off[owner + 1] - np.arange(len(flat))
    rows, cols = [np.arange(len(which))], [T.mix(w.hashes()[which] ^ np.uint64(0x1E81C))]
    gram = flat
    for n in range(2, max(NGRAMS) + 1):
        gram = (gram[:-1] << np.uint64(8)) | flat[n - 1 :]
        if n in NGRAMS:
            whole = left[: len(gram)] >= n
            rows.append(owner[: len(gram)][whole])
            cols.append(T.mix(gram[whole] ^ np.uint64(n << 40)))
    row, col = np.concatenate(rows), (np.concatenate(cols) & np.uint64(size - 1)).astype(np.int64)
    order = np.argsort(row, kind="stable")
    return col[order], np.searchsorted(row[order], np.arange(len(which) + 1))


def emissions(weights: np.ndarray, col: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The sum of each word's rows of weights, for some words at a time."""
    n, k = len(off) - 1, weights.shape[1]
    out = np.zeros((n, k), weights.dtype)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + max(1, BLOCK // max(1, k)), "right")) - 1)
        out[a:b] = np.add.reduceat(weights[col[off[a] : off[b]]], off[a:b] - off[a], axis=0)
        a = b
    return out


def word_weights(w: T.Words, which: np.ndarray, model: Model) -> np.ndarray:
    """Emissions of some words by a model."""
    col, off = features(w, which, len(model.slot))
    return emissions(model.weights, model.slot[col], off)


# ---------------------------------------------------------------- training


def _forward_backward(e: np.ndarray, move: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (sequences, words, languages) and summed pair posteriors, for sequences of equal length."""
    n, t, k = e.shape
    x = np.exp(e - e.max(2, keepdims=True))
    m, s = np.exp(move), np.exp(start)
    a, b = np.empty_like(x), np.empty_like(x)
    a[:, 0] = s * x[:, 0]
    a[:, 0] /= a[:, 0].sum(1, keepdims=True)
    for i in range(1, t):
        a[:, i] = (a[:, i - 1] @ m) * x[:, i]
        a[:, i] /= a[:, i].sum(1, keepdims=True)
    b[:, -1] = 1
    pair = np.zeros((k, k))
    for i in range(t - 2, -1, -1):
        y = b[:, i + 1] * x[:, i + 1]
        b[:, i] = y @ m.T
        pair += (a[:, i] / (a[:, i] * b[:, i]).sum(1, keepdims=True)).T @ y
        b[:, i] /= b[:, i].sum(1, keepdims=True)
    g = a * b
    return g / g.sum(2, keepdims=True), pair * m


def train(texts: list[str], labels: list[str], seed: int = 5, steps: int = STEPS) -> Model:
    """A model from windows of text, each in one language."""
    langs = sorted(set(labels))
    number, k = {x: i for i, x in enumerate(langs)}, len(langs)
    w = T.words(pa.array(texts, pa.string()))
    which, code = distinct(w)
    rng = np.random.default_rng(seed)
    own = np.array([number[x] for x in labels])
    rows = [np.arange(w.first[i], w.first[i + 1]) for i in range(len(texts))]
    # Pure sequences: windows cut to SEQUENCE words, repeated from their start where short.
    ids, tags = [], []
    usable = [i for i in range(len(texts)) if len(rows[i])]
    for i in usable:
        for a in range(0, len(rows[i]), SEQUENCE):
            part = rows[i][a : a + SEQUENCE]
            ids.append(np.resize(part, SEQUENCE))
            tags.append(np.full(SEQUENCE, own[i]))
    # Spliced sequences: two to four stretches of random windows.
    for _ in range(len(ids)):
        cuts = np.sort(rng.choice(np.arange(1, SEQUENCE), int(rng.integers(1, 4)), replace=False))
        x, y = [], []
        for size in np.diff(np.concatenate([[0], cuts, [SEQUENCE]])):
            i = usable[int(rng.integers(len(usable)))]
            a = int(rng.integers(len(rows[i])))
            x.append(np.resize(rows[i][a:], size))
            y.append(np.full(size, own[i]))
        ids.append(np.concatenate(x))
        tags.append(np.concatenate(y))
    size = table_size(k)
    if not ids:
        return Model(langs, np.zeros((1, k), np.float32), np.zeros((k, k)), np.zeros(k), np.zeros(size, np.int32))
    word, tag = code[np.array(ids)], np.array(tags)
    # Rare languages count as much as frequent ones.
    col, off = features(w, which, size)
    seen, col = np.unique(col, return_inverse=True)
    owner = np.repeat(np.arange(len(which)), np.diff(off))
    kind = np.float64 if k <= WIDE else np.float32
    weights, move, start = np.zeros((len(seen), k), kind), np.zeros((k, k)), np.zeros(k)
    squares = [np.full_like(v, 1e-8) for v in (weights, move, start)]
    # What does not change: how often a word, a pair or a first word has a language.
    true = np.zeros((len(which), k), kind)
    np.add.at(true, (word.reshape(-1), tag.reshape(-1)), 1)
    pairs = np.zeros((k, k))
    np.add.at(pairs, (tag[:, :-1].reshape(-1), tag[:, 1:].reshape(-1)), 1)
    firsts = np.bincount(tag[:, 0], minlength=k).astype(float)
    block = max(1, BLOCK // (SEQUENCE * k))
    for _ in range(steps):
        e, by_word, both, first = emissions(weights, col, off), true.copy(), np.zeros((k, k)), firsts.copy()
        for a in range(0, len(word), block):
            part = word[a : a + block]
            post, some = _forward_backward(e[part], move, start)
            both += some
            first -= post[:, 0].sum(0)
            post = post.reshape(-1, k)
            for j in range(k):
                by_word[:, j] -= np.bincount(part.reshape(-1), post[:, j], len(which))
        grad = np.stack([np.bincount(col, by_word[owner, j], len(seen)) for j in range(k)], 1) - 0.05 * weights
        for v, g, s in zip((weights, move, start), (grad, pairs - both - 0.05 * move, first), squares, strict=True):
            s += g * g
            v += 0.3 * g / np.sqrt(s)
    slot = np.zeros(size, np.int32)
    slot[seen] = np.arange(1, len(seen) + 1)
    return Model(langs, np.concatenate([np.zeros((1, k)), weights]).astype(np.float32), move, start, slot)


def table_size(k: int) -> int:
    """Hashed features of a model of k languages: a power of two, with at most TABLE weights in all."""
    return min(FEATURES, 1 << (max(1, TABLE // max(1, k)).bit_length() - 1))


# ---------------------------------------------------------------- inference


def posteriors(e: np.ndarray, fresh: np.ndarray, model: Model) -> np.ndarray:
    """Posterior of each word of a chain with emissions e; fresh marks the first word of a document."""
    n, k = e.shape
    if not n:
        return e
    segments = -(-n // SEGMENT)
    x = np.ones((segments * SEGMENT, k), np.float32)
    x[:n] = np.exp(e - e.max(1, keepdims=True))
    new = np.zeros(segments * SEGMENT, bool)
    new[:n] = fresh
    new[n:] = True  # what fills the last segment tells nothing about the words before it
    x, new = x.reshape(segments, SEGMENT, k), new.reshape(segments, SEGMENT)
    m = np.exp(model.move - model.move.max()).astype(np.float32)
    s = np.exp(model.start - model.start.max()).astype(np.float32)

    def norm(v):
        v /= v.sum(axis=-1, keepdims=True)
        return v

    # Transfer matrices: row i is the state after the segment if it was i before.
    p = np.broadcast_to(np.eye(k, dtype=np.float32), (segments, k, k)).copy()
    scale = np.zeros((segments, k), np.float64)
    for i in range(SEGMENT):
        step = (p.reshape(-1, k) @ m).reshape(segments, k, k)
        at = new[:, i]
        if at.any():
            step[at] = s
            scale[at] = 0
        step *= x[:, i, None, :]
        total = step.sum(2)
        scale += np.log(total)
        p = step / total[:, :, None]
    before = np.empty((segments, k), np.float32)
    state = np.full(k, 1 / k, np.float32)
    lift = np.exp(scale - scale.max(1, keepdims=True))
    for j in range(segments):
        before[j] = state
        state = norm((state * lift[j]) @ p[j]).astype(np.float32)
    a = np.empty_like(x)
    state = before
    for i in range(SEGMENT):
        step = state @ m
        step[new[:, i]] = s
        state = norm(step * x[:, i])
        a[:, i] = state
    # Backward: what follows a segment, as seen from its end.  A fresh word tells nothing about the words before it.
    after = np.empty((segments, k), np.float32)
    state = np.ones(k, np.float32)
    holds = new.any(1)
    for j in range(segments - 1, -1, -1):
        after[j] = state
        state = np.ones(k, np.float32) if holds[j] else norm(lift[j] * (p[j] @ state)).astype(np.float32)
    # From the segment's first word back to the last word of the one before: the segment's part before its first fresh word.
    for j in np.flatnonzero(holds):
        if j == 0:
            continue
        v, stop = np.ones(k, np.float32), int(new[j].argmax())
        for i in range(stop - 1, -1, -1):
            v = norm(m @ (x[j, i] * v))
        after[j - 1] = v
        q = j - 1
        while not holds[q] and q > 0:
            after[q - 1] = norm(lift[q] * (p[q] @ after[q])).astype(np.float32)
            q -= 1
    b = after
    for i in range(SEGMENT - 1, -1, -1):
        a[:, i] *= b
        b = norm((x[:, i] * b) @ m.T)
        b[new[:, i]] = 1
    return norm(a.reshape(-1, k)[:n])


def side_by_side(w: T.Words, which: np.ndarray, code: np.ndarray, letter: np.ndarray, model: Model) -> np.ndarray:
    """Sums of the posteriors of each text's words with a letter: the texts go word by word, at their own ends they leave."""
    k, counts = len(model.langs), w.counts()
    m = np.exp(model.move - model.move.max()).astype(np.float32)
    s = np.exp(model.start - model.start.max()).astype(np.float32)
    total = np.zeros((len(counts), k))
    longest = np.argsort(-counts, kind="stable")
    longest = longest[counts[longest] > 0]

    def norm(v):
        return v / v.sum(axis=1, keepdims=True)

    def steps(rows, t, last):
        """For each word number from t to last: its place in each of the texts that go on, and its emissions."""
        alive = np.searchsorted(-counts[rows], -np.arange(t, last), "left")
        at = [w.first[rows[:n]] + i for n, i in zip(alive, range(t, last), strict=True)]
        distinct_code, back = np.unique(code[np.concatenate(at)], return_inverse=True)
        e = word_weights(w, which[distinct_code], model)
        x = np.exp(e - e.max(1, keepdims=True))
        ends = np.cumsum(alive)
        return [(a, x, back[to - n : to]) for a, n, to in zip(at, alive, ends, strict=True)]

    def forward(state, place):
        a, x, back = place
        n = len(a)
        return norm((s if state is None else state[:n] @ m) * x[back])

    per = max(1, BLOCK // (SEGMENT * k))
    for lo in range(0, len(longest), per):
        rows = longest[lo : lo + per]
        most = int(counts[rows[0]])
        held, state = [], None
        for t in range(0, most, SEGMENT):
            held.append(state)
            if t + SEGMENT < most:
                for place in steps(rows, t, t + SEGMENT):
                    state = forward(state, place)
        after = np.ones((0, k), np.float32)
        for j in range(len(held) - 1, -1, -1):
            places, states, state = steps(rows, j * SEGMENT, min(most, (j + 1) * SEGMENT)), [], held[j]
            for place in places:
                state = forward(state, place)
                states.append(state)
            for (a, x, back), state in zip(reversed(places), reversed(states), strict=True):
                b = np.ones_like(state)  # a text's last word has nothing after it
                b[: len(after)] = after
                total[rows[: len(a)]] += norm(state * b) * letter[a][:, None]
                after = norm((x[back] * b) @ m.T)
    return total


def _letters(data: np.ndarray) -> np.ndarray:
    return ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128)


def predict(col: pa.Array, model: Model) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    w = T.words(col)
    n, k = len(w.first) - 1, len(model.langs)
    total = np.zeros((n, k))
    if w.n and k:
        which, code = distinct(w)
        letter = np.add.reduceat(_letters(w.data).astype(np.int64), w.start) > 0
        if k > WIDE:
            total = side_by_side(w, which, code, letter, model)
        else:
            fresh = np.zeros(w.n, bool)
            fresh[w.first[:-1][w.counts() > 0]] = True
            post = posteriors(word_weights(w, which, model)[code], fresh, model) * letter[:, None]
            full = w.counts() > 0
            total[full] = np.add.reduceat(post, w.first[:-1][full], axis=0)
    best, mass = total.argmax(1) if k else np.zeros(n, int), total.sum(1)
    lang, score = [UNKNOWN] * n, [0.0] * n
    ascii_letters = np.concatenate([[0], np.cumsum(((w.data | 32) >= 97) & ((w.data | 32) <= 122))])
    has = ascii_letters[w.off[1:]] > ascii_letters[w.off[:-1]]
    for i in np.flatnonzero(mass > 0):
        if has[i] or any(c.isalpha() for c in bytes(w.data[w.off[i] : w.off[i + 1]]).decode()):
            lang[i], score[i] = model.langs[best[i]], float(min(1.0, total[i, best[i]] / mass[i]))
    return lang, score


# ---------------------------------------------------------------- Spark


def learn(docs: DataFrame, modulus: int = 4, held_out: int = 2, per_lang: int = PER_LANG, window: int = WINDOW, most_rows: int = ROWS) -> Model:
    """A model of every language of the documents (doc_id, text, lang) that are not held out."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    rows = rows.where(F.col("lang").isNotNull() & (F.coalesce(fold_of(modulus), F.lit(-1)) != held_out))
    rows = rows.withColumn("key", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    found = rows.groupBy("lang").agg(F.approx_count_distinct("key").alias("different")).limit(MOST + 1).toArrow()
    if not found.num_rows:
        return Model([], np.zeros((1, 0), np.float32), np.zeros((0, 0)), np.zeros(0), np.zeros(FEATURES, np.int32))
    if found.num_rows > MOST:
        raise ValueError(f"lang has more than {MOST} values: that is more than one driver can learn")
    per_lang = max(1, min(per_lang, most_rows // found.num_rows))
    # Several times what is wanted of the different documents of each language; equal ones have one key.
    limits = found.append_column("limit", pa.array([int(min(1.0, 4 * max(16, per_lang) / max(1, n)) * (1 << 30)) for n in found.column("different").to_pylist()], pa.int64()))
    limits = F.broadcast(docs.sparkSession.createDataFrame(limits.select(["lang", "limit"])))  # at most MOST rows
    chosen = rows.join(limits, "lang").where(F.pmod("key", F.lit(1 << 30)) < F.col("limit"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                w = T.words(part.column("text"))
                h, out = w.hashes(), []
                for i, text in enumerate(part.column("text").to_pylist()):
                    lo, hi, base = int(w.first[i]), int(w.first[i + 1]), int(w.off[i])
                    if hi - lo > window:
                        lo += int(h[lo] % np.uint64(hi - lo - window + 1))
                        hi = lo + window
                    out.append(text.encode()[w.start[lo] - base : w.end[hi - 1] - base].decode() if hi > lo else "")
                yield pa.record_batch([part.column("lang"), part.column("key"), pa.array(out, pa.string())], names=["lang", "key", "text"])

    some = chosen.select("lang", "key", "text").mapInArrow(windows, "lang string, key long, text string").where("text <> ''").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key", "text"))
    sample = some.withColumn("rank", rank).where(F.col("rank") <= per_lang).select("lang", "text").toArrow().sort_by([("lang", "ascending"), ("text", "ascending")])
    return train(sample.column("text").to_pylist(), sample.column("lang").to_pylist())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of each row of docs (doc_id, text)."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                lang, score = predict(part.column("text"), sent.value)
                yield pa.record_batch([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of docs, all columns, whose language is known with a score of at least least."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                lang, score = predict(part.column("text"), sent.value)
                yield part.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(lang, score, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def language_id(docs: DataFrame, modulus: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row, by a model learned from the rows not held out."""
    found = identify(docs, learn(docs, modulus, held_out))
    return found.select("doc_id", F.coalesce(fold_of(modulus) == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
