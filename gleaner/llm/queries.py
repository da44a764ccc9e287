"""The queries of this subpackage: opN_<name>, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import table
from .byte_bpe import byte_bpe
from .decontamination import contamination
from .fingerprints import edited_fingerprints
from .hard_negatives import hard_negatives
from .html_extract import main_text
from .language_id import language_id
from .near_duplicates import near_duplicates
from .packing import pack
from .quality import quality_scores
from .substring_dedup import substring_digests
from .token_counts import token_counts
from .vector_codes import vector_codes
from .vector_search import nearest


def op1_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_digests(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = (F.col("label") + 1) % 10
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, other).otherwise(F.col("label")))
    return hard_negatives(vectors, vectors.where("vec_id % 100 = 0"), positives=5, k=5, low=80, high=100)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings")).drop("label")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_vector_search, op2_html_extract, op3_token_counts, op4_best_fit_packing, op5_language_id,
        op6_byte_bpe, op7_quality, op8_fingerprints, op9_substring_dedup, op10_near_duplicates,
        op11_hard_negatives, op12_decontamination, op13_vector_codes,
    )
    return {f.__name__: f for f in ops}


_WORDS = r"[x FOR x IN regexp_split_to_array({text}, '[\x20\x09-\x0D]+') IF x <> '']"
_LARGE, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Window by window: each is compared with all others by its words.
_OP9 = f"""WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, p, md5(array_to_string(list_slice(ws, p, p + 49), ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM w)),
earlier AS (SELECT h, min(doc_id) AS least FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM win JOIN earlier USING (h) WHERE doc_id > least),
each AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

#: All pairs with a common shingle; classes by walking along links.
_OP10 = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{_LARGE}', '{_SMALL}')")} AS ws FROM documents),
sh AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) >= 5 THEN [array_to_string(list_slice(ws, i, i + 4), ' ') FOR i IN range(1, len(ws) - 3)] WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS s FROM w),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM pair JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE c >= 0.8 * (p.n + q.n - c) - 1e-9),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
class AS (SELECT x, min(y) AS class_id FROM reach GROUP BY x), links AS (SELECT x, count(*) AS n FROM both_ways GROUP BY x)
SELECT w.doc_id, class_id, coalesce(links.n, 0) AS n_links FROM w JOIN class ON class.x = w.doc_id LEFT JOIN links ON links.x = w.doc_id"""


_WHOLE = "embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"

#: Every pair of an anchor and another row, ranked by windows.
_OP11 = f"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS c FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_WHOLE}),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.c, b.c)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.own AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score QUALIFY rank <= 5"""

#: Every window of every document as a string, joined with those of the items.
_OP12 = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_LARGE}', '{_SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_LARGE}', '{_SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT item_id, least(len(ws), 10) AS n, array_to_string(list_slice(ws, p, p + least(len(ws), 10) - 1), ' ') AS k FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS p FROM i WHERE len(ws) > 0)),
place AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win)),
occ AS (SELECT doc_id, p, w.n, item_id FROM (SELECT doc_id, p, n, array_to_string(list_slice(ws, p, p + n - 1), ' ') AS k FROM place) a JOIN win w ON w.k = a.k AND w.n = a.n),
hit AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(it.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""


def _op13(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """The rounds one after another; the least of distance * entries + entry is the nearest entry and its distance."""
    sql = f"""WITH kept AS (SELECT vec_id, label, [floor({scale} * x::DOUBLE) FOR x IN embedding] AS c, row_number() OVER (ORDER BY vec_id) AS r FROM embeddings WHERE {_WHOLE}),
part AS MATERIALIZED (SELECT vec_id, r, k, list_slice(c, k * (len(c) // {parts}) + 1, (k + 1) * (len(c) // {parts})) AS v FROM kept, range({parts}) t(k)),
c0 AS MATERIALIZED (SELECT k, r - 1 AS e, v FROM part WHERE r <= {entries})"""
    for i in range(rounds + 1):
        sql += f""",
a{i} AS MATERIALIZED (SELECT p.vec_id, p.k, any_value(p.v) AS v, min((list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, c.v) + list_inner_product(c.v, c.v))::BIGINT * {entries} + c.e) AS best FROM part p JOIN c{i} c ON c.k = p.k GROUP BY p.vec_id, p.k)"""
        if i < rounds:
            sql += f""",
m{i} AS (SELECT k, e, list(floor(s / n) ORDER BY i) AS v FROM (SELECT k, best % {entries} AS e, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, unnest(range(1, len(v) + 1)) t(i) GROUP BY ALL) GROUP BY k, e),
c{i + 1} AS MATERIALIZED (SELECT c.k, c.e, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON m.k = c.k AND m.e = c.e)"""
    return f"""{sql},
coded AS (SELECT vec_id, string_agg(printf('%02x', best % {entries}), '' ORDER BY k) AS code, sum(best // {entries})::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, (SELECT sha256(string_agg(v[i]::BIGINT::VARCHAR, ',' ORDER BY k, e, i)) FROM c{rounds}, unnest(range(1, len(v) + 1)) t(i)) AS codebooks_sha256 FROM coded JOIN kept USING (vec_id)"""


def oracle_sql() -> dict[str, str]:
    """Queries of this subpackage that SQL can express."""
    return {"op9_substring_dedup": _OP9, "op10_near_duplicates": _OP10, "op11_hard_negatives": _OP11, "op12_decontamination": _OP12, "op13_vector_codes": _op13()}
