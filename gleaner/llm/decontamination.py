"""Benchmark decontamination with DataFrame functions alone.

ASCII capitals count as small; words are runs of characters other than the ASCII ones
that are neither letters nor digits.  A *window* is ``width`` consecutive words of a benchmark item;
an item of fewer words is one window.  A document word is hit if it lies inside an
occurrence of a window.

1.  The distinct windows of all items, with a hash of each, are a small table.  Which
    items hold a window is told by the sum and the exclusive or of the items' hashes,
    so windows of the same items share a *group* and no list of items is gathered.
2.  A document's words are hashed once; hashes of 2, 4 and 8 words are made of those of
    half as many, and those of a window of these, so a window costs a few operations
    whatever its width.
3.  Each window of a document is looked up by its hash in the broadcast table; in the same
    step the words themselves are compared.  Windows that meet nothing end there: no
    exchange sees them.
4.  What is hit (document, place, length, group) is small, and comes with one row for each
    document and its number of words, so texts are read once.  A document is told by its id
    and the hash of its text, so rows that are equal share their hits.

The table is broadcast only if its measured size is at most ``BROADCAST``; a larger one is
sorted and merged with the documents' windows, dealt by their hash, and a very common
window is split by the engine's handling of skewed joins.

Defined cases: a null text has no words, and an item without words no window; repeated
rows each give a row; a null doc_id is an id like others; items of one item_id count as one
item, and those without an id hit words but are not listed; n_items counts distinct
ids; empty tables give no hits or no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import cut, grows

#: Words of a window.
WIDTH = 10
#: Bytes of the windows' words, and 64 for each window, that are broadcast at most.
BROADCAST = 64 << 20
# The ASCII letters, and the characters that are no word's.
LARGE, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Names of columns on the way; no table has them.
DOC, TAG, WORDS = "__gleaner_doc", "__gleaner_tag", "__gleaner_words"
SPANS, PIECES, GONE = "__gleaner_spans", "__gleaner_pieces", "__gleaner_gone"


def words(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    small = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, LARGE, SMALL))
    return F.coalesce(F.array_remove(F.split(small, f"{BREAK}+"), ""), F.array().cast("array<string>"))


def hashed_windows(df: DataFrame, width: int, name: str) -> DataFrame:
    """df (column WORDS) with the hashes of all windows of width words, in order, as the column name.

    Each step is a column of its own, so that none is computed twice.
    """
    size = F.greatest(F.size(WORDS) - F.lit(width - 1), F.lit(0))
    if width == 1:
        return df.withColumn(name, F.transform(WORDS, lambda w: F.xxhash64(w)))
    out, step, made, at = df.withColumn("__1", F.transform(WORDS, lambda w: F.xxhash64(w))), 1, None, 0
    after = lambda x, n: F.slice(x, n + 1, F.size(x))
    while True:
        if width & step:  # the next ``step`` words of the window, after those that are in it
            part = after(f"__{step}", at) if at else F.col(f"__{step}")
            out = out.withColumn(f"__w{step}", part if made is None else F.zip_with(F.col(made), part, lambda a, b: F.xxhash64(a, b)))
            made, at = f"__w{step}", at + step
        if 2 * step > width:
            break
        out = out.withColumn(f"__{2 * step}", F.zip_with(F.col(f"__{step}"), after(f"__{step}", step), lambda a, b: F.xxhash64(a, b)))
        step *= 2
    return out.withColumn(name, F.slice(F.col(made), F.lit(1), size)).select(*df.columns, name)


def windows(items: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(windows, groups) of items (item_id, text): hash, length, words and group of each distinct window, and the items (item_id) of each group."""
    read = items.select("item_id", words(F.col("text").cast("string")).alias(WORDS))
    length = F.least(F.size(WORDS), F.lit(width))
    lengths = sorted(r.n for r in read.where(F.size(WORDS) > 0).select(length.alias("n")).distinct().collect())  # at most width of them
    each = items.select("item_id").where("false").withColumns({"hash": F.lit(0).cast("long"), "length": F.lit(0), "window": F.array().cast("array<string>")})
    for n in lengths:
        own = hashed_windows(read.where(length == n), n, "_h").select("item_id", WORDS, F.posexplode_outer("_h").alias("_at", "hash"))
        each = each.unionByName(own.select("item_id", "hash", F.lit(n).alias("length"), F.slice(WORDS, F.col("_at") + 1, F.lit(n)).alias("window")))
    each = cut(each.distinct())
    code = F.xxhash64("item_id")
    # Sums of 128-bit-like numbers: two independent ones tell sets of items apart.
    by_window = each.groupBy("hash", "length", "window").agg(F.sum(code.cast("decimal(38,0)")).alias("_s"), F.bit_xor(F.xxhash64(F.lit(7), "item_id")).alias("_x"), F.count("item_id").alias("_n"))
    known = cut(by_window.withColumn("group", F.xxhash64("_s", "_x", "_n")).select("hash", "length", "window", "group"))
    first = known.groupBy("group").agg(F.min(F.struct("hash", "length", "window")).alias("_w")).select("group", "_w.*")
    groups = cut(each.where("item_id is not null").join(first, ["hash", "length", "window"]).select("group", "item_id").distinct())
    return known, groups


def _told(docs: DataFrame) -> DataFrame:
    """docs with their id and the hash of their text."""
    return docs.withColumns({DOC: F.col("doc_id"), TAG: F.xxhash64(F.col("text").cast("string"))})


def scan(docs: DataFrame, known: DataFrame, broadcast: int = BROADCAST) -> DataFrame:
    """DOC, TAG, n_words, at, length and group of each occurrence of a window in docs (doc_id, text), and of each row of docs one with ``head``.

    Places are from 0.  Where a head is no occurrence, its group is null.  All are found in one reading of the texts.
    """
    size = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(F.concat_ws(" ", "window"))), F.lit(0)).alias("bytes"), F.collect_set("length").alias("lengths")).first()  # a few lengths
    small = size.bytes + 64 * size.n <= broadcast
    read = _told(docs).select(DOC, TAG, words(F.col("text").cast("string")).alias(WORDS))
    n_words = F.size(WORDS).cast("long").alias("n_words")
    lengths = sorted(size.lengths)
    found = None
    if not (small and lengths):
        found = read.select(DOC, TAG, n_words, *(F.lit(None).cast(t).alias(c) for c, t in (("at", "int"), ("length", "int"), ("group", "long"))), F.lit(True).alias("head"))
    for n in lengths:
        # Outer, and without a condition on the words: a filter would be computed below, from the text, once more.
        own = hashed_windows(read, n, "_h").select(DOC, TAG, WORDS, F.posexplode_outer("_h").alias("at", "_hash"))
        these = known.where(F.col("length") == n).drop("length")
        window = F.slice(WORDS, F.col("at") + 1, F.lit(n))
        if small:  # the words are compared where the hash is found; as a second key they would be cut out for every window
            met = own.join(F.broadcast(these), (F.col("_hash") == F.col("hash")) & F.coalesce(window == F.col("window"), F.lit(False)), "left" if found is None else "inner")
        else:  # only the window's words are sent
            met = own.select(DOC, TAG, F.lit(0).alias("_n"), "at", "_hash", window.alias("_window")).join(grows(these), (F.col("_hash") == F.col("hash")) & (F.col("_window") == F.col("window")))
        head = F.coalesce("at", F.lit(0)) == 0 if found is None else F.lit(False)
        part = met.select(DOC, TAG, n_words if small else F.col("_n").cast("long").alias("n_words"), "at", F.lit(n).alias("length"), "group", head.alias("head")).where("head or group is not null")
        found = part if found is None else found.unionByName(part)
    return found


def hits(docs: DataFrame, known: DataFrame, broadcast: int = BROADCAST) -> DataFrame:
    """DOC, TAG, at and length of the places in docs where a window begins."""
    return scan(docs, known, broadcast).where("group is not null").select(DOC, TAG, "at", "length").distinct()


def _hit_words(spans: Column) -> Column:
    """The number of words in the union of spans (at, length), which are sorted."""
    step = lambda a, s: F.struct((a["n"] + F.greatest(s["at"] + s["length"] - F.greatest(s["at"], a["to"]), F.lit(0))).alias("n"), F.greatest(a["to"], s["at"] + s["length"]).alias("to"))
    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), step, lambda a: a["n"].cast("long"))


def _spans(found: DataFrame) -> DataFrame:
    """DOC, TAG and spans, the sorted (at, length) of the occurrences in each document; there are no more of them than the document has words, for each length."""
    return found.groupBy(DOC, TAG).agg(F.array_sort(F.collect_set(F.struct("at", "length"))).alias("spans"))


def _met(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """docs (told) joined with what was found of them."""
    other = found.withColumnsRenamed({DOC: f"{DOC}_", TAG: f"{TAG}_"})
    out = docs.join(other, docs[DOC].eqNullSafe(other[f"{DOC}_"]) & docs[TAG].eqNullSafe(other[f"{TAG}_"]), how)
    return out.drop(f"{DOC}_", f"{TAG}_")


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, broadcast: int = BROADCAST) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each row of docs (doc_id, text), by the windows of items (item_id, text)."""
    known, groups = windows(items, width)
    read = cut(scan(docs.select("doc_id", "text"), known, broadcast))
    found = read.where("group is not null").select(DOC, TAG, "at", "length", "group").distinct()
    spans = _spans(found).select(DOC, TAG, _hit_words(F.col("spans")).alias("n_hit"))
    met = found.select(DOC, TAG, "group").distinct().join(groups, "group").select(DOC, TAG, F.col("item_id").cast("string").alias("item")).distinct()
    # The list of a document's items is what the result digests.
    named = met.groupBy(DOC, TAG).agg(F.array_sort(F.collect_list("item")).alias("items"))
    each = cut(_met(spans, named, "left").select(DOC, TAG, "n_hit", F.size(F.coalesce("items", F.array())).cast("long").alias("n_items"), F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256")))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    out = _met(read.where("head").select(F.col(DOC).alias("doc_id"), DOC, TAG, "n_words"), each, "left")
    return out.select("doc_id", "n_words", zero("n_hit"), zero("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def without_documents(docs: DataFrame, items: DataFrame, width: int = WIDTH, broadcast: int = BROADCAST) -> DataFrame:
    """The rows of docs, all columns, in which no word is hit."""
    known, _ = windows(items, width)
    found = cut(hits(docs, known, broadcast).select(DOC, TAG).distinct())
    return _met(_told(docs), found, "left_anti").drop(DOC, TAG)


def without_spans(docs: DataFrame, items: DataFrame, width: int = WIDTH, broadcast: int = BROADCAST) -> DataFrame:
    """The rows of docs, all columns, without the words that are hit; what stands before a word goes with it, all else stays as it is."""
    known, _ = windows(items, width)
    spans = cut(_spans(hits(docs, known, broadcast)).withColumnRenamed("spans", SPANS))
    gone = F.flatten(F.transform(SPANS, lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1)))
    # Each piece ends with a word; what follows the last word is the rest.
    pieces = F.regexp_extract_all("text", F.lit(rf"{BREAK}*[^{BREAK[1:-1]}]+"), F.lit(0))
    rest = F.regexp_extract("text", rf"({BREAK}*)\z", 1)
    left = F.array_except(F.sequence(F.lit(0), F.size(PIECES) - 1), GONE)
    text = F.concat(F.array_join(F.transform(left, lambda i: F.get(PIECES, i)), ""), rest)
    plain = [c for c in docs.columns if c != "text"]
    told = _met(_told(docs.withColumn("text", F.col("text").cast("string"))), spans, "left")
    cleaned = told.where(F.col(SPANS).isNotNull()).withColumns({PIECES: pieces, GONE: gone}).withColumn("text", text).select(*docs.columns)
    return told.where(F.col(SPANS).isNull()).select(*plain, "text").select(*docs.columns).unionByName(cleaned)
