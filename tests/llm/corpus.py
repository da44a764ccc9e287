"""Small documents for the tests: ordinary ones, copies, and awkward ones."""

import random

from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use on the way; tables may have such columns too.
CLASHING = ["spans", "node", "size", "keys", "run", "ahead", "tie", "bin", "shard", "cluster", "first", "last", "anchor", "stretch", "score", "text_key", "rank", "block", "a", "b", "copies", "component", "first_id", "held_out", "counts", "quality"]


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def ordinary(seed=1, n=60):
    """(id, text) with exact copies, near copies, shared passages, texts of few words."""
    rng = random.Random(seed)
    passage = " ".join(words(rng, 70))
    out = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and out:
            text = rng.choice(out)[1]
        elif kind == 2 and out:
            own = rng.choice(out)[1].split(" ")
            if own:
                own[rng.randrange(len(own))] = "changed"
            text = " ".join(own)
        elif kind == 3:
            text = " ".join(words(rng, rng.randrange(40))) + "\n" + passage + " " + " ".join(words(rng, rng.randrange(60)))
        elif kind == 4:
            text = " ".join(words(rng, rng.randrange(8)))
        else:
            text = " ".join(words(rng, rng.randrange(30, 160)))
        out.append((100 - i, text))
    return out


AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "été x y\x1cz"), (6, "x" * 70_000), (7, "123 !!! 456"), (8, "🙂 ሕግ 中文 ok"),
    (None, "no id here but some words to read"), (None, None), (9, "a b c d e"), (10, "A B C D E"), (11, ("long text of many words " * 9000).strip()), (12, "<|endoftext|> it's\r\n"),
]


def frame(spark, rows, clash=True):
    df = spark.createDataFrame([(i, t, ("en" if (i or 0) % 2 else "de") if (i or 1) % 5 else None, f"s{(i or 0) % 4}" if (i or 1) % 7 else None, None if t is None else len(t)) for i, t in rows], COLUMNS)
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if clash else df
