"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

1.  Texts become sets of five-word shingles.  Rows with one set are one *node*; its
    copies are never expanded into pairs.
2.  Each node has one signature, a sequence of ``depth`` MinHash values, for each of
    ``trees`` prefix tries, packed so that sorting signatures keeps the order of
    prefixes, and a sketch of two bits of all its values.
3.  A pair of similarity s shares a prefix of length d in some trie with the
    probability 1 - (1 - s**d) ** trees.  Matched prefixes are shortened from the
    full depth, level by level, until every node of a bounded sample is expected to
    meet its partners with the target recall.  The similarities that this needs are
    measured: the sample's sketches are compared with those of all nodes
    (`matched_depth`).  A sample without partners takes the length at which a pair
    right at the threshold is met with that recall, which is also the shortest.
4.  The tries are one sorted table.  Nodes that share a prefix are a run of it; in a
    run sketches are compared, and the links of similar ones (`SLACK` under the
    threshold) are kept as far as they join what was apart, so a run gives fewer links
    than it has nodes.  No run is paired in rows.  All nodes of a run are compared,
    whatever its size and wherever partitions cut it: runs that are cut, and those of more
    than ``LARGE`` nodes, are dealt in blocks of which any two meet in one task.  Their
    cost grows with the square of their unlike nodes, the memory of a task does not.
5.  The forest and its sketches may miss a pair, so what they left apart is looked for
    exactly (`missed`).  Sets of similarity >= threshold share one of the first
    size - ceil(threshold * size) + 1 shingles of each, in any one order of all shingles; those
    that come often in one of eight texts stand last, which sets the cost, not the result.
    Of shingles whose nodes are not all joined, pairs of nodes that are apart are
    compared: by size, by parity bits, whose difference is at most that of the sets, and
    those that these leave by their whole sets.  What is similar joins the links.
6.  What these links join is verified exactly: a component's shingle sets are
    compared in blocks of bounded size, each pair once, and only counts and classes
    come out.  A set is sent once for each block of its component; a block holds
    ``BLOCK_NODES`` sets, so nearly all components are one block.  Texts of which no set is
    wanted are left out, by a filter of ``FILTER`` bits, before texts are dealt to those that are.

Result: one row for each document with its class (the least doc_id of all that
are linked, directly or through others) and its number of links, that is, the
other documents of similarity >= threshold; copies count.

Defined cases: words are runs without white space, ASCII capitals count as small;
a text of fewer than five words is one shingle of all its words; a null text, and
one without words, is its own class without links; a row without an id has no
class id unless documents with ids are linked to it; repeated rows are copies; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text as T
from ..session import ship
from ._graph import components, roots
from ._spark import cut, grows, release

WIDTH, THRESHOLD, RECALL = 5, 0.8, 0.999
TREES, DEPTH = 20, 8
#: Nodes whose partners are looked for among all others, to measure similarities.
SAMPLE = 512
#: Sketches of a pair are taken as similar down to the threshold less this: four standard errors.
SLACK = 0.15
#: Nodes and shingles of a block at most; two blocks are compared in one task, so many nodes of each at a time.
BLOCK_NODES, BLOCK_SHINGLES, STEP = 4096, 1 << 20, 256
#: Nodes of a run that one task compares at most; nodes with which trees begin together; pairs of sketches that are held at a time.
LARGE, TREES_AT_ONCE, CELLS = 1 << 15, 64, 1 << 17
#: A component of more nodes than this is cut into up to SPREAD blocks, so that their pairs are dealt to several tasks.
ONE_TASK, SPREAD = 512, 4
#: One of so many texts is looked through for shingles that come often, of which so many at most stand last in the order of shingles.
ORDERED_BY, FREQUENT = 8, 1 << 18
#: Words of 64 parity bits of a set; nodes of one shingle in a block, of which two meet in one task.
PARITY, SHARING = 8, 4096
#: Bits of the filter by which texts that nothing asks for are left out before any is sent, in words of 64.
FILTER = 1 << 24
#: Name of a column that is added to the documents on the way; no table has it.
TAG = "__gleaner_tag"


def prefix_depth(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold meets in some trie with the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(w: T.Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in the order of the rows, and the row offsets."""
    n = w.counts()
    h = w.hashes(0, fold=True)
    g = T.grams(h, width)
    row = w.row()
    full = np.flatnonzero(row[: len(g)] == row[width - 1 :]) if len(g) else np.zeros(0, np.int64)
    size = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    off = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(off[-1], np.uint64)
    long_rows = np.repeat(n >= width, size)
    out[long_rows] = g[full]
    for i in np.flatnonzero((n > 0) & (n < width)):
        out[off[i]] = T.grams(h[w.first[i] : w.first[i + 1]], int(n[i]))[0] ^ np.uint64(0xA5A5A5A5 + int(n[i]))
    return out, off


def sets(w: T.Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each row, and the row offsets."""
    h, off = shingles(w, width)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.searchsorted(row[new], np.arange(len(off)))


def set_keys(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent numbers that tell sets apart."""
    size = np.diff(off)
    out = []
    for seed in (31, 32):
        total = np.zeros(len(size), np.uint64)
        full = np.flatnonzero(size)
        if len(full):
            total[full] = np.add.reduceat(T.mix(h ^ T.stream(seed, 1)[0]), off[:-1][full])
        out.append(T.mix(total + size.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def signatures(h: np.ndarray, off: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """For each row the values of all tries, (rows, trees, depth) of 16 bits, and its sketch, (rows, words) of 64 bits: two bits of each value."""
    count = trees * depth
    full = np.flatnonzero(np.diff(off))
    begin, ends = off[:-1][full], off[1:][full]
    a, b = T.stream(11, count) | np.uint64(1), T.stream(12, count)
    least = np.zeros((count, len(off) - 1), np.uint64)
    cuts = [0]
    while cuts[-1] < len(full):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, begin[cuts[-1]] + (1 << 15), "right"))))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        own, at = h[begin[lo] : ends[hi - 1]], begin[lo:hi] - begin[lo]
        for k in range(count):
            least[k, full[lo:hi]] = np.minimum.reduceat(own * a[k] + b[k], at)
    least = T.mix(least.T)
    values = (least >> np.uint64(48)).astype(np.uint16).reshape(-1, trees, depth)
    sketch = np.zeros((len(least), -(-count // 32)), np.uint64)
    for k in range(count):
        sketch[:, k // 32] |= (least[:, k] & np.uint64(3)) << np.uint64(2 * (k % 32))
    return values, sketch


def parities(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parity bits of each set, as (rows, PARITY) of 64 bits, and as many as it has shingles or more, with offsets.

    Each bit tells whether the number of the set's shingles that fall to it is odd, so two
    sets differ in as many shingles as bits, or more.  The number of words is PARITY times a
    power of two; words of equal remainder fold to fewer by exclusive or.
    """
    size = np.diff(off)
    words = PARITY << np.ceil(np.log2(np.maximum(size / (64 * PARITY), 1))).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(words)])
    x = T.mix(h ^ T.stream(33, 1)[0])
    wide, few = np.zeros(at[-1], np.uint64), np.zeros((len(size), PARITY), np.uint64)
    np.bitwise_xor.at(wide, np.repeat(at[:-1], size) + ((x >> np.uint64(32)).view(np.int64) & np.repeat(words - 1, size)), np.uint64(1) << (x & np.uint64(63)))
    np.bitwise_xor.at(few, (np.repeat(np.arange(len(size)), words), (np.arange(len(wide)) - np.repeat(at[:-1], words)) % PARITY), wide)
    return few, wide, at


def prefixes(h: np.ndarray, off: np.ndarray, threshold: float, often: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of each set of which a similar set has one among its own, and the row offsets; often: sorted shingles that stand last, by times."""
    size = np.diff(off)
    rank = np.zeros(len(h), np.uint16)
    if len(often) and len(h):
        at = np.minimum(np.searchsorted(often, h), len(often) - 1)
        rank = np.where(often[at] == h, times[at], 0).astype(np.uint16)
    row = np.repeat(np.arange(len(size)), size)
    order = np.argsort(rank, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    taken = np.clip(size - np.ceil(threshold * size - 1e-6).astype(np.int64) + 1, 0, size)
    own = np.arange(len(h)) - np.repeat(off[:-1], size) < np.repeat(taken, size)
    return h[order][own], np.concatenate([[0], np.cumsum(taken)])


def packed(values: np.ndarray) -> np.ndarray:
    """(rows, trees, 2) numbers of 64 bits whose order is that of the sequences of values; up to eight values of 16 bits."""
    rows, trees, depth = values.shape
    out = np.zeros((rows, trees, 2), np.uint64)
    for k in range(depth):
        out[:, :, k // 4] |= values[:, :, k].astype(np.uint64) << np.uint64(48 - 16 * (k % 4))
    return out


def agreeing(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """How many of the count values behind two (arrays of) sketches have the same two bits."""
    x = a ^ b
    return count - np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(-1, dtype=np.int64)


def _similar(threshold: float, count: int) -> float:
    """The least number of agreeing values of sketches that are taken as similar: a pair agrees in s + (1 - s) / 4 of them."""
    s = max(0.0, threshold - SLACK)
    return count * (s + (1 - s) / 4)


def _lists(values: np.ndarray, off: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.ascontiguousarray(values).view(np.int64).reshape(-1)))


def often_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that several different texts of a share of docs (text, tag) have, the most frequent ones, and how many have each."""
    asked = docs.where(F.pmod("tag", F.lit(ORDERED_BY)) == 0).select("tag", "text").dropDuplicates(["tag"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                yield pa.record_batch([pa.array(sets(T.words(part.column("text")), width)[0].view(np.int64))], names=["h"])

    most = cut(asked.mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("times")).where("times > 1").orderBy(F.desc("times"), "h").limit(FREQUENT).select("h", F.least("times", F.lit((1 << 15) - 1)).cast("short").alias("times")))
    found = most.toArrow()
    release(most)
    h, times = found.column("h").to_numpy().view(np.uint64), found.column("times").to_numpy()
    order = np.argsort(h)
    return h[order], times[order]


def _signed(docs: DataFrame, width: int, trees: int, depth: int, threshold: float) -> DataFrame:
    """doc_id, tag (of its text), k1 and k2 (of its set), size (of its set), sig (two numbers for each trie), sketch, parity and wide (few and more parity bits) and prefix of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(often_shingles(docs, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, times = sent.value
        for batch in batches:
            for part in T.slices(batch, "text"):
                h, off = sets(T.words(part.column("text")), width)
                values, sketch = signatures(h, off, trees, depth)
                few, *wide = parities(h, off)
                lists = lambda x: _lists(x, np.arange(len(x) + 1) * x.shape[1])
                yield pa.record_batch(
                    [
                        part.column("doc_id"), part.column("tag"), *map(pa.array, set_keys(h, off)), pa.array(np.diff(off), pa.int64()),
                        lists(packed(values).reshape(len(values), -1)), lists(sketch), lists(few), _lists(*wide), _lists(*prefixes(h, off, threshold, often, times)),
                    ],
                    names=["doc_id", "tag", "k1", "k2", "size", "sig", "sketch", "parity", "wide", "prefix"],
                )

    return docs.mapInArrow(run, "doc_id long, tag long, k1 long, k2 long, size long, sig array<long>, sketch array<long>, parity array<long>, wide array<long>, prefix array<long>")


def matched_depth(nodes: DataFrame, n: int, threshold: float, recall: float, trees: int, depth: int, sample: int = SAMPLE) -> int:
    """The longest prefix by which each node of a sample of nodes (n, sketch) is expected to meet its partners among all nodes with the recall."""
    least = prefix_depth(threshold, recall, trees, depth)
    share = min(1.0, sample / max(1, n))
    asked = nodes.where(F.pmod(F.xxhash64("n"), F.lit(1 << 30)) < int(share * (1 << 30))).select("n", "sketch").toArrow()
    if not asked.num_rows or least == depth:
        return least
    count = trees * depth
    sent = nodes.sparkSession.sparkContext.broadcast((asked.column("n").to_numpy(), np.array(asked.column("sketch").to_pylist(), np.int64).view(np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sketches = sent.value
        met, partners = np.zeros((len(own), depth)), np.zeros(len(own))
        for batch in batches:
            node = batch.column("n").to_numpy()
            lists = batch.column("sketch")
            each = lists.flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
            for lo in range(0, len(node), 1024):
                same = agreeing(sketches[:, None], each[None, lo : lo + 1024], count)
                i, j = np.nonzero(same >= count * (threshold + (1 - threshold) / 4))
                other = own[i] != node[lo : lo + 1024][j]
                i, s = i[other], np.clip((same[i[other], j[other]] / count - 0.25) / 0.75, 0, 1)
                np.add.at(partners, i, 1)
                for d in range(1, depth + 1):
                    np.add.at(met[:, d - 1], i, 1 - (1 - s**d) ** trees)
        at = np.flatnonzero(partners)
        yield pa.record_batch([pa.array(own[at]), pa.array(partners[at]), *(pa.array(met[at, d]) for d in range(depth))], names=["n", "partners", *(f"d{d + 1}" for d in range(depth))])

    names = ["partners", *(f"d{d + 1}" for d in range(depth))]
    found = nodes.select("n", "sketch").mapInArrow(run, "n long, " + ", ".join(f"{x} double" for x in names)).groupBy("n").agg(*(F.sum(x).alias(x) for x in names))
    worst = found.agg(F.count("*").alias("nodes"), *(F.min(F.col(x) / F.col("partners")).alias(x) for x in names[1:])).first()
    if not worst["nodes"]:
        return least
    return next((d for d in range(depth, least, -1) if worst[f"d{d}"] >= recall), least)


def _near(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """(n, m): which of n and m sketches, (words, n) and (words, m), differ in so many values at most; words that cannot change that are left out."""
    out = np.empty((x.shape[1], y.shape[1]), bool)
    step = max(1, CELLS // x.shape[1])
    for lo in range(0, y.shape[1], step):
        differ = np.uint16(0)
        for own, other in zip(x, y[:, lo : lo + step], strict=True):
            v = own[:, None] ^ other
            v |= v >> np.uint64(1)
            v &= np.uint64(0x5555555555555555)
            differ = differ + np.bitwise_count(v)
            near = differ <= most
            if not near.any():
                break
        out[:, lo : lo + step] = near
    return out


def run_links(node: np.ndarray, sketch: np.ndarray, similar: float, count: int, deeper: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links of a run's nodes by similar sketches, as far as they join what was apart: a spanning forest.

    Nodes are compared tree by tree: a tree takes in all that is similar to any of its
    nodes, so every pair of nodes that are left is compared, however many they are.  Nodes
    that are like none of those left go by up to ``TREES_AT_ONCE``.  deeper, values of
    the trie below the run's prefix, (nodes, levels), sets nothing but the order.
    """
    order = np.argsort(node, kind="stable") if deeper is None else np.lexsort((node, *deeper.T[::-1]))
    node, words, most = node[order], np.ascontiguousarray(sketch[order].T), int(np.floor(count - similar))
    a, b = [], []
    begun = 1
    while len(node) > 1:
        near = _near(words[:, :begun], words, most)
        np.fill_diagonal(near, False)
        alone = int(np.argmax(np.append(near.any(1), True)))  # nodes before the first that is like another
        node, words = node[alone:], words[:, alone:]
        if alone == len(near):
            begun = min(2 * begun, TREES_AT_ONCE)
            continue
        begun = 1
        edge, reach, node, words = node[:1], words[:, :1], node[1:], words[:, 1:]
        while len(edge) and len(node):
            now, near = edge[:STEP], _near(reach[:, :STEP], words, most)
            got = near.any(0)
            a.append(now[near.argmax(0)[got]])
            b.append(node[got])
            edge, reach = np.concatenate([edge[STEP:], node[got]]), np.concatenate([reach[:, STEP:], words[:, got]], 1)
            node, words = node[~got], words[:, ~got]
    return (np.concatenate(a), np.concatenate(b)) if a else (node[:0], node[:0])


def unpacked(hi: np.ndarray, lo: np.ndarray, begin: int, depth: int) -> np.ndarray:
    """(rows, depth - begin): the values from a level on, out of the packed numbers."""
    words = (hi.view(np.uint64), lo.view(np.uint64))
    return np.stack([(words[k // 4] >> np.uint64(48 - 16 * (k % 4))).astype(np.uint16) for k in range(begin, depth)], 1) if begin < depth else np.zeros((len(hi), 0), np.uint16)


_FOUND = "a long, b long, part int, tree int, hi long, lo long, sketch array<long>"


def _linked(found: DataFrame, sketch: list[str], mask: list[np.ndarray], count: int, similar: float) -> DataFrame:
    """Links (a, b) of the runs of sorted rows (tree, hi, lo, n, sketch); and all rows of the runs that are not done with here.

    These are the first and the last run of each partition, which may go on in others,
    and runs of more than ``LARGE`` nodes, of which nothing is compared here.
    """
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def links(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links of all runs of some rows, and the sizes of the runs."""
        new = np.ones(len(rows["n"]), bool)
        new[1:] = _differs(rows, slice(1, None), slice(None, -1))
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(new)))
        node, s = rows["n"], rows["s"]
        two = begin[size == 2]
        two = two[agreeing(s[two], s[two + 1], count) >= similar]
        a, b = [node[two]], [node[two + 1]]
        here = (size > 2) & (size <= LARGE)
        for at, n in zip(begin[here].tolist(), size[here].tolist(), strict=True):
            x, y = run_links(node[at : at + n], s[at : at + n], similar, count)
            a.append(x)
            b.append(y)
        return np.concatenate(a), np.concatenate(b), size

    def _differs(rows, x, y):
        return (rows["tree"][x] != rows["tree"][y]) | ((rows["hi"][x] ^ rows["hi"][y]) & mask[0] != 0) | ((rows["lo"][x] ^ rows["lo"][y]) & mask[1] != 0)

    def told(rows: dict[str, np.ndarray], part: int, first: bool, last: bool) -> Iterator[pa.RecordBatch]:
        a, b, size = links(rows)
        n, none = len(a), pa.nulls(len(a), pa.int64())
        yield pa.record_batch([pa.array(a), pa.array(b), none.cast(pa.int32()), none.cast(pa.int32()), none, none, pa.nulls(n, pa.list_(pa.int64()))], names=names)
        later = size > LARGE
        later[0] |= first
        later[-1] |= last
        own = {k: v[np.repeat(later, size)] for k, v in rows.items()}
        if n := len(own["n"]):
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * own["s"].shape[1], pa.int32()), pa.array(np.ascontiguousarray(own["s"]).view(np.int64).reshape(-1)))
            yield pa.record_batch([pa.array(own["n"]), pa.nulls(n, pa.int64()), pa.array(np.full(n, part, np.int32)), pa.array(own["tree"]), pa.array(own["hi"]), pa.array(own["lo"]), lists], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: list[dict[str, np.ndarray]] = []  # of the last run, which may go on in the next batch
        whole = lambda: {k: np.concatenate([h[k] for h in held]) for k in held[0]}
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {k: batch.column(k).to_numpy() for k in ("tree", "hi", "lo", "n")} | {"s": np.stack([batch.column(x).to_numpy() for x in sketch], 1).view(np.uint64)}
            last = len(rows["n"])
            differs = _differs(rows, slice(None), slice(last - 1, last))
            at = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0  # where the batch's last run begins
            if held and bool(_differs({k: np.concatenate([held[-1][k][-1:], v[:1]]) for k, v in rows.items()}, slice(0, 1), slice(1, 2))[0]):
                yield from told(whole(), part, first, False)  # the held run has ended
                held, first = [], False
            if at:
                held.append({k: v[:at] for k, v in rows.items()})
                yield from told(whole(), part, first, False)
                held, first = [], False
            held.append({k: v[at:] for k, v in rows.items()})
        if held:
            yield from told(whole(), part, first, True)

    return found.mapInArrow(run, _FOUND)


def _links(nodes: DataFrame, trees: int, depth: int, matched: int, threshold: float) -> DataFrame:
    """Candidate links (a, b) from the sorted tries of nodes (n, sig, sketch), of which prefixes of the matched length count."""
    count = trees * depth
    words = -(-count // 32)
    sketch = [f"s{i}" for i in range(words)]
    each = F.explode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), F.get(F.col("sig"), 2 * t).alias("hi"), F.get(F.col("sig"), 2 * t + 1).alias("lo"))))
    tries = cut(nodes.select("n", *(F.get(F.col("sketch"), F.lit(i)).alias(s) for i, s in enumerate(sketch)), each.alias("_t")).select("_t.*", "n", *sketch))
    mask = [np.array([((1 << 64) - (1 << (64 - 16 * d))) if d < 4 else (1 << 64) - 1 for d in (min(matched, 4), max(matched - 4, 0))], np.uint64).view(np.int64)[i] for i in (0, 1)]
    sorted_rows = tries.repartitionByRange("tree", "hi", "lo", "n").sortWithinPartitions("tree", "hi", "lo", "n")
    similar = _similar(threshold, count)
    found = cut(_linked(sorted_rows, sketch, mask, count, similar))
    release(tries)
    inner = found.where("part is null").select("a", "b")
    # Runs that partitions cut, and large ones: all their nodes are compared, in blocks of which any two meet in one task.
    prefix = [F.col("tree"), F.col("hi").bitwiseAND(F.lit(int(mask[0]))).alias("p"), F.col("lo").bitwiseAND(F.lit(int(mask[1]))).alias("q")]
    edges = found.where("part is not null").select("part", *prefix, F.col("a").alias("n"), "sketch")
    opened = cut(edges.groupBy("tree", "p", "q").agg(F.min("part").alias("x"), F.max("part").alias("y"), F.count("*").alias("rows")).where((F.col("x") < F.col("y")) | (F.col("rows") > LARGE)).select("tree", "p", "q", "rows"))
    if opened.isEmpty():
        return inner
    blocks = F.when(F.col("rows") > LARGE, F.ceil(F.col("rows") / (LARGE // 2))).otherwise(1).cast("int")
    over = edges.join(opened, ["tree", "p", "q"]).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int"))
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("block")))
    met = over.withColumn("other", F.explode(others)).select("tree", "p", "q", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "n", "sketch")

    def both(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node = table.column("n").to_numpy()
        a, b = run_links(node, table.column("sketch").chunk(0).flatten().to_numpy().view(np.uint64).reshape(len(node), -1), similar, count)
        return pa.table({"a": a, "b": b})

    return inner.unionByName(cut(met.groupBy("tree", "p", "q", "i", "j").applyInArrow(both, "a long, b long")))


def _common(h: np.ndarray, off: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The number of shingles that each row of left shares with each of right."""
    rows = np.union1d(left, right)
    size = np.diff(off)[rows]
    at = np.repeat(off[:-1][rows] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    _, code, df = np.unique(h[at], return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(rows)), size)
    shared = df[code] > 1
    row, code = row[shared], (np.cumsum(df > 1) - 1)[code[shared]]
    x, y = np.searchsorted(rows, left), np.searchsorted(rows, right)
    out = np.zeros((len(left), len(right)), np.float32)
    step = 4096
    for lo in range(0, int((df > 1).sum()), step):
        own = (code >= lo) & (code < lo + step)
        m = np.zeros((len(rows), step), np.float32)
        m[row[own], code[own] - lo] = 1
        out += m[x] @ m[y].T
    return out


def compare(block: np.ndarray, weight: np.ndarray, h: np.ndarray, off: np.ndarray, pair: tuple[int, int], threshold: float, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """For each node of two blocks (or one): weights of the nodes it links to between them, and the first node of those it is linked to, directly or through others."""
    n, size = len(block), np.diff(off)
    left, right = np.flatnonzero(block == pair[0]), np.flatnonzero(block == pair[1])
    links, a, b = np.zeros(n, np.int64), [np.arange(n)], [np.arange(n)]
    for i in range(0, len(left), step):
        for j in range(0, len(right), step):
            if pair[0] == pair[1] and j < i:
                continue
            x, y = left[i : i + step], right[j : j + step]
            common = _common(h, off, x, y)
            linked = common >= threshold * (size[x][:, None] + size[y][None, :] - common) - 1e-6
            same = pair[0] == pair[1] and i == j
            if same:
                np.fill_diagonal(linked, False)
            links[x] += linked.astype(np.int64) @ weight[y]
            if not same:
                links[y] += linked.T.astype(np.int64) @ weight[x]
            p, q = np.nonzero(linked)
            if len(p):
                node, root = roots(x[p], y[q])
                a.append(root)
                b.append(node)
    return links, roots(np.concatenate(a), np.concatenate(b))[1]


def _among(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """All rows of docs (doc_id, tag) that are among wanted (_id, tag), and few others: by a filter of a bounded size, which each task has."""
    bits = wanted.select(F.pmod(F.xxhash64("tag", "_id"), F.lit(FILTER)).alias("_cell")).groupBy(F.shiftright("_cell", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_cell % 64 as int))")).alias("_bits"))
    placed = docs.withColumn("_cell", F.pmod(F.xxhash64("tag", "doc_id"), F.lit(FILTER)))
    return placed.join(F.broadcast(bits), (F.shiftright("_cell", 6) == F.col("_word")) & (F.getbit("_bits", F.col("_cell") % 64) == 1), "left_semi").drop("_cell")


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int, carried: str) -> DataFrame:
    """The carried columns of wanted nodes (n, _id, tag, k1, k2) and their shingles; a node may come from several tasks."""
    # The text of each node's first row; the tag tells rows without an id, or with one id, apart.
    docs = _among(docs, wanted)
    texts = docs.join(grows(wanted), (docs["tag"] == wanted["tag"]) & docs["doc_id"].eqNullSafe(wanted["_id"]))
    names = [c.split()[0] for c in carried.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # a row that comes often gives its set once for each task
        for batch in batches:
            for part in T.slices(batch, "text"):
                h, off = sets(T.words(part.column("text")), width)
                k1, k2 = set_keys(h, off)
                own = (k1 == part.column("k1").to_numpy()) & (k2 == part.column("k2").to_numpy())
                for i, x in enumerate(part.column("n").to_pylist()):
                    own[i] &= x not in done
                    if own[i]:
                        done.add(x)
                yield pa.record_batch([*(part.column(c) for c in names), _lists(h, off)], names=[*names, "shingles"]).filter(pa.array(own))

    return texts.select("text", "k1", "k2", *names).mapInArrow(run, f"{carried}, shingles array<long>")


def missed(nodes: DataFrame, threshold: float) -> DataFrame | None:
    """Pairs (a, b), all that can have the threshold, of nodes (n, c, size, parity, wide, prefix) whose components c are different; None if there are none."""
    shared = Window.partitionBy("t")
    # Nodes of shingles whose nodes are not all joined.
    apart = cut(
        nodes.select("n", "c", F.explode("prefix").alias("t")).withColumns({"x": F.min("c").over(shared), "y": F.max("c").over(shared)})
        .where("x < y").select("t", "n", "c")
    )
    if apart.isEmpty():
        release(apart)
        return None
    # The nodes outside a shingle's largest component meet all of it, in blocks.
    each = apart.groupBy("t", "c").agg(F.count("*").alias("k")).groupBy("t").agg(F.max(F.struct("k", "c")).alias("m"), F.sum("k").alias("k"))
    blocks = lambda k: F.ceil(k / SHARING).cast("int")
    dealt = each.select("t", F.col("m.c").alias("top"), blocks(F.col("k") - F.col("m.k")).alias("few"), blocks(F.col("k")).alias("all"))
    bits = [f"p{i}" for i in range(PARITY)]
    known = nodes.select("n", "size", *(F.get("parity", F.lit(i)).alias(x) for i, x in enumerate(bits)))
    rows = cut(apart.join(grows(dealt), "t").join(grows(known), "n"))
    release(apart)
    own = lambda k: F.pmod(F.xxhash64("n"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    left = rows.where("c <> top").withColumns({"i": own("few"), "j": every("all")}).alias("l")
    right = rows.withColumns({"j": own("all"), "i": every("few")}).alias("r")
    x, y = (lambda c: F.col(f"l.{c}")), (lambda c: F.col(f"r.{c}"))
    differ = sum((F.bit_count(x(p).bitwiseXOR(y(p))) for p in bits[1:]), F.bit_count(x(bits[0]).bitwiseXOR(y(bits[0]))))
    met = left.join(
        grows(right),
        (x("t") == y("t")) & (x("i") == y("i")) & (x("j") == y("j")) & (x("c") != y("c")) & ((y("c") == y("top")) | (x("n") < y("n")))
        & (F.least(x("size"), y("size")) >= threshold * F.greatest(x("size"), y("size")) - 1e-5)
        & (differ * (1 + threshold) <= (x("size") + y("size")) * (1 - threshold) + 1e-5),
    )
    close = met.select(F.least(x("n"), y("n")).alias("a"), F.greatest(x("n"), y("n")).alias("b")).distinct()
    # Of sets for which few bits say little, all bits are compared.
    of = lambda k: nodes.select(F.col("n").alias(k), F.col("size").alias(f"{k}_size"), F.col("wide").alias(f"{k}_wide"))
    words = F.least(F.size("a_wide"), F.size("b_wide"))
    fold = lambda bits, i: F.aggregate(F.sequence(i, F.size(bits) - 1, words), F.lit(0).cast("long"), lambda v, k: v.bitwiseXOR(F.get(bits, k)))
    differ = F.aggregate(F.sequence(F.lit(0), words - 1), F.lit(0), lambda v, i: v + F.bit_count(fold(F.col("a_wide"), i).bitwiseXOR(fold(F.col("b_wide"), i))))
    known = close.join(grows(of("a")), "a").join(grows(of("b")), "b")
    pairs = cut(known.where(differ * (1 + threshold) <= (F.col("a_size") + F.col("b_size")) * (1 - threshold) + 1e-5).select("a", "b"))
    release(rows)
    return None if pairs.isEmpty() else pairs


def _similar_pairs(docs: DataFrame, pairs: DataFrame, source: DataFrame, width: int, threshold: float) -> DataFrame:
    """Those of pairs (a, b) whose sets have the threshold."""
    asked = pairs.select(F.col("a").alias("n")).unionByName(pairs.select(F.col("b").alias("n"))).distinct()
    wanted = cut(asked.join(grows(source), "n"))
    full = cut(_sets_of(docs, wanted, width, "n long").dropDuplicates(["n"]))
    of = lambda k: full.select(F.col("n").alias(k), F.col("shingles").alias(f"{k}_set"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    met = pairs.join(grows(of("a")), "a").join(grows(of("b")), "b").select("a", "b", (F.size("a_set") + F.size("b_set")).alias("both"), common.alias("common"))
    similar = cut(met.where(F.col("common") >= threshold * (F.col("both") - F.col("common")) - 1e-6).select("a", "b"))
    release(wanted, full)
    return similar


_VERIFIED = "n long, links long, root long, first_id long, whole boolean"


def _classified(docs: DataFrame, threshold: float, width: int, recall: float, trees: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, tag, row, size, k1, k2), and for each set (k1, k2) its node n, first_id, class_id, n_links and whether it is the first of its class (keeper)."""
    ship(docs.sparkSession)
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tag"))
    signed = cut(_signed(docs, width, trees, depth, threshold).withColumn("row", F.monotonically_increasing_id()))
    rows = cut(signed.select("doc_id", "tag", "row", "size", "k1", "k2"))
    # A node is named by its first row.
    nodes = cut(rows.where("size > 0").groupBy("k1", "k2").agg(F.min("row").alias("n"), F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.max("size").alias("size")))
    # The wide columns are sent in two parts, of which neither is held beside the other's exchange.
    forest = cut(signed.select(F.col("row").alias("n"), "sig", "sketch").join(grows(nodes.select("n")), "n", "left_semi"))
    matched = matched_depth(forest, nodes.count(), threshold, recall, trees, depth)
    source = rows.select(F.col("row").alias("n"), F.col("doc_id").alias("_id"), "tag", "k1", "k2")
    comp = cut(components(_links(forest, trees, depth, matched, threshold)).withColumnRenamed("node", "n"))
    release(forest)
    placed = nodes.select("n").join(grows(comp), "n", "left").select("n", F.coalesce("component", "n").alias("c"))
    apart = cut(signed.select(F.col("row").alias("n"), "size", "parity", "wide", "prefix").join(grows(placed), "n"))
    release(signed)
    pairs = missed(apart, threshold)
    release(apart)
    if pairs is not None:
        more = _similar_pairs(docs, pairs, source, width, threshold)
        release(pairs)
        if not more.isEmpty():
            before, comp = comp, cut(components(comp.select(F.col("n").alias("a"), F.col("component").alias("b")).unionByName(more)).withColumnRenamed("node", "n"))
            release(before)
        release(more)
    members = cut(comp.join(grows(nodes.select("n", "first_id", "copies", "size")), "n"))
    few = F.when(F.count("*") > ONE_TASK, F.least(F.ceil(F.count("*") / ONE_TASK), F.lit(SPREAD))).otherwise(1)
    sizes = members.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("size") / BLOCK_SHINGLES), few).cast("int").alias("blocks"))
    wanted = cut(
        members.join(grows(sizes), "component").join(grows(source), "n")
        .select("n", "first_id", "copies", "component", "blocks", F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int").alias("block"), "_id", "tag", "k1", "k2")
    )
    release(comp, members)
    full = _sets_of(docs, wanted, width, "n long, first_id long, copies long, component long, blocks int, block int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = full.withColumn("other", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")

    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("n")
        n = table.column("n").to_numpy()
        new = np.flatnonzero(np.diff(n, prepend=n[:1] - 1))
        if len(new) < len(n):  # from several tasks
            table, n = table.take(pa.array(new)).combine_chunks(), n[new]
        table = table.combine_chunks()
        lists = table.column("shingles").chunk(0)
        h = lists.flatten().to_numpy().view(np.uint64)
        off = lists.offsets.to_numpy().astype(np.int64)
        links, root = compare(table.column("block").to_numpy(), table.column("copies").to_numpy(), h, off - off[0], (table.column("i")[0].as_py(), table.column("j")[0].as_py()), threshold)
        at = np.flatnonzero(links)
        return pa.table(
            {"n": pa.array(n[at]), "links": pa.array(links[at]), "root": pa.array(n[root[at]]), "first_id": table.column("first_id").take(pa.array(at)), "whole": pa.array(np.full(len(at), table.column("blocks")[0].as_py() == 1))}
        )

    verified = cut(pairs.groupBy("component", "i", "j").applyInArrow(verify, _VERIFIED))
    release(wanted)
    # Components of one block have their classes; the others' are joined over their blocks.
    over = verified.where("not whole")
    joined = components(over.select(F.col("n").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "n").withColumnRenamed("component", "root")
    classes = cut(
        verified.where("whole").select("n", "links", "root", "first_id")
        .unionByName(over.groupBy("n").agg(F.sum("links").alias("links"), F.max("first_id").alias("first_id")).join(grows(joined), "n").select("n", "links", "root", "first_id"))
    )
    # The first of a class: of the nodes with the least id, or, where none has one, of all, the least.
    least = classes.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "n")).alias("_f"))
    known = classes.join(grows(least), "root").select("n", "links", F.col("_f.first_id").alias("class_id"), (F.col("n") == F.col("_f.n")).alias("_first"))
    every = nodes.join(grows(known), "n", "left").select(
        "k1", "k2", "n", "first_id", F.coalesce("class_id", "first_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("_first", F.lit(True)).alias("keeper"),
    )
    return rows, cut(every)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """doc_id, class_id and n_links of each row of docs (doc_id, text)."""
    rows, known = _classified(docs, threshold, width, recall, trees, depth)
    worded = F.col("size") > 0
    return rows.join(grows(known), ["k1", "k2"], "left").select("doc_id", F.when(worded, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.coalesce(F.when(worded, F.col("n_links")), F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """The rows of docs, all columns, without near duplicates: of each class one document stays, that with the least id.

    Documents are told apart by id and text, so different texts of one id are
    different documents, each with its class.  Of rows equal in both, one stays.  A class
    without any id keeps one of its rows; a row without words is its own class, and
    all of those without an id stay.
    """
    rows, known = _classified(docs, threshold, width, recall, trees, depth)
    first = rows.where("size > 0").join(grows(known.where("keeper").select("k1", "k2", "n", "first_id")), ["k1", "k2"]).where("doc_id <=> first_id")
    stay = first.groupBy("n").agg(F.min_by("tag", "row").alias("tag"), F.max("doc_id").alias("doc_id"), (F.count("*") > 1).alias("many"))
    blank = rows.where("size = 0").groupBy("doc_id", "tag").agg((F.col("doc_id").isNotNull() & (F.count("*") > 1)).alias("many"))
    keys = cut(stay.select("doc_id", "tag", "many").unionByName(blank.select("doc_id", "tag", "many")))
    tagged = docs.withColumn(TAG, F.xxhash64(F.col("text").cast("string")))
    met = lambda k: tagged.join(grows(k), (tagged[TAG] == k["tag"]) & F.col("doc_id").cast("long").eqNullSafe(k["_id"]), "left_semi")
    named = keys.withColumnRenamed("doc_id", "_id")
    once = met(named)
    often = keys.where("many")
    if not often.isEmpty():
        once = met(named.where("not many")).unionByName(met(named.where("many")).dropDuplicates(["doc_id", TAG]))
    return once.drop(TAG)
