"""The pipeline against a version of its stages told plainly, and the registered queries."""

from collections import Counter

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from gleaner.llm import language_id, packing, quality, queries as llm_queries
from tests.conftest import SMALL
from tests.llm.corpus import AWKWARD, frame, ordinary
from tests.llm.test_duplicates import classes, kept


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = language_id.learn(docs)
    lang, score = language_id.predict(pa.array(list(rows.values())), model)
    want = {i: t for (i, t), x, s in zip(rows.items(), lang, score, strict=True) if x != "und" and s >= cp.LANGUAGE_SCORE}
    one = cp.identify_language(spark, docs, SMALL)
    assert {r.doc_id: r.text for r in one.collect()} == want and one.schema == docs.schema

    good = quality.learn(one, spark.read.parquet(f"{SMALL}/labels.parquet"))
    marks = quality.vote(quality.term_counts(pa.array(list(want.values()))), good)
    want = {i: t for (i, t), s in zip(want.items(), marks, strict=True) if s >= cp.QUALITY_SCORE}
    two = cp.classify_quality(spark, one, SMALL)
    assert {r.doc_id: r.text for r in two.collect()} == want and two.schema == docs.schema

    stay = {c for _, c, _ in classes(sorted(want.items()))}
    want = {i: t for i, t in want.items() if i in stay}
    three = cp.join_near_duplicates(spark, two, SMALL)
    assert {r.doc_id: r.text for r in three.collect()} == want and three.columns == docs.columns

    left = {i: (n - gone, digest) for i, n, gone, digest in kept(sorted(want.items()), 50)}
    four = cp.remove_substrings(spark, three, SMALL)
    assert four.columns == docs.columns
    import hashlib

    got = {r.doc_id: r for r in four.collect()}
    assert {i: (len(r.text.encode().split()), hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest()) for i, r in got.items()} == {i: x for i, x in left.items() if x[0]}
    assert all(r.n_chars == len(r.text) for r in got.values())

    packed = cp.pack_sequences(spark, four, SMALL).collect()
    assert sum(r.size for r in packed) == sum(len(r.text.encode()) for r in got.values()) and len({r.doc_id for r in packed}) == len(got)
    assert max(r.bin_offset + r.size for r in packed) <= packing.CAPACITY

    whole = cp.run(spark, SMALL).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, packed))


@pytest.mark.parametrize("name, stage", cp.STAGES)
def test_stages_on_awkward_tables(spark, tmp_path, name, stage):
    """Nulls, empty and long texts, repeated rows and ids, clashing columns; and an empty table."""
    rows = [*AWKWARD, *ordinary(3, 30), (4, "another text of an id that comes often"), (None, "x y z"), (None, "x y z")]
    docs, at = frame(spark, rows), str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    got, empty = stage(spark, docs, at), stage(spark, docs.limit(0), at)
    assert empty.count() == 0 and empty.columns == got.columns
    out = got.collect()
    if name == "packing":
        assert sum(r.size for r in out) == sum(len((t or "").encode()) for _, t in rows) and sum(r.bin is None for r in out) == sum(not t for _, t in rows)
        return
    assert got.columns == docs.columns
    kept_rows = Counter((r.doc_id, r.text) for r in out)
    if name == "language_id":
        assert not any(t is None or not any(c.isalpha() for c in t) for _, t in kept_rows) and kept_rows[4, "one"] in (0, 2)
    if name == "quality":  # no label: all stay
        assert kept_rows == Counter(rows)
    if name == "near_duplicates":
        assert set(kept_rows) <= set(rows) and kept_rows[4, "one"] == 1 and kept_rows[4, "another text of an id that comes often"] == 1 and kept_rows[None, "x y z"] == 1 and kept_rows[1, None] == 1
    if name == "substring_dedup":
        assert kept_rows[4, "one"] == 2 and kept_rows[1, None] == 1 and kept_rows[None, "x y z"] == 2 and all(r.n_chars == (None if r.text is None else len(r.text)) for r in out)


@pytest.mark.parametrize("name", sorted(llm_queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        duck.sql(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    want = duck.sql(llm_queries.oracle_sql()[name])
    got = llm_queries.queries()[name](spark, "/root/testdata/sf0.01").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_operators_ship_the_package(spark, monkeypatch):
    """Called as functions on any table, not only through the queries, the operators make the package known to the executors."""
    from gleaner.llm import byte_bpe, fingerprints, html_extract, near_duplicates, substring_dedup, token_counts, vector_search

    def shipped(module, call):
        seen = []
        monkeypatch.setattr(module, "ship", seen.append)
        call()
        assert seen == [spark] * len(seen) and seen

    docs = frame(spark, [(1, "some words")])
    for module, call in (
        (byte_bpe, lambda: byte_bpe.byte_bpe(docs)), (fingerprints, lambda: fingerprints.edited_fingerprints(docs)), (html_extract, lambda: html_extract.main_text(docs.selectExpr("1 as page_id", "'' as url", "text as html"))),
        (near_duplicates, lambda: near_duplicates.near_duplicates(docs)), (substring_dedup, lambda: substring_dedup.substring_digests(docs)), (token_counts, lambda: token_counts.token_counts(docs)),
        (packing, lambda: packing.pack(docs)), (language_id, lambda: language_id.learn(docs)), (quality, lambda: quality.learn(docs, docs.selectExpr("doc_id", "1 as quality"))),
        (vector_search, lambda: vector_search.nearest(docs.selectExpr("doc_id as vec_id", "array(1f) as embedding").limit(0), docs.selectExpr("doc_id as vec_id", "array(1f) as embedding"))),
    ):
        shipped(module, call)


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(n.split("_")[0] for n in names) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])
    assert cp.ORACLE_SQL is None and 4 <= len(cp.STAGES) <= 5
