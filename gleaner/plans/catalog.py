"""The registered queries of the engine, each with SQL that computes it another way."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import url as U
from ..functions.filenames import derive_filename
from ..functions.text import before_hyphen, decode_content_disposition, percent_decode, sanitize_filename
from ..operators import dedupe, extract, listing, outcome, registry, responses
from ..session import local_path, shared_dir, ship
from ..sources.fetch import write_documents
from ..sources.files import delete, list_files
from ..sources.sink import stage_bodies
from . import site

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
#: Downloads after which the limited runs stop.
LIMIT = 500
#: The same for the crawl that is run with its effects.
RUN = 12


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        _QUERIES[f.__name__] = run
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "pages").select("page_id", F.col("url").alias("page_url"), "html")


def _decoded(expr: str) -> str:
    return f"replace(replace(replace(replace(replace({expr}, '&quot;', '\"'), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


# ------------------------------------------------------------------ pages

_H1 = _decoded("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")


@query(f"SELECT page_id, trim({_H1}) AS title FROM pages")
def page_titles(spark, sf_dir):
    """The title of every page."""
    return extract.parse_pages(_pages(spark, sf_dir), keep=("page_id",), want=("title",)).select("page_id", F.col("parsed.title").alias("title"))


_ANCHORS = r"""a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
  generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 AS pos FROM pages),
r AS (SELECT page_id, pos, {href} AS href, regexp_extract(url, '^(https?://[^/?#]*)', 1) || {href} AS resolved FROM a)""".replace("{href}", _decoded("href"))


@query(f"WITH {_ANCHORS} SELECT page_id, min(pos) AS pos, resolved AS url FROM r GROUP BY page_id, resolved")
def page_anchors_resolved(spark, sf_dir):
    """The resolved links of every page, the first of each URL."""
    parsed = extract.parse_pages(_pages(spark, sf_dir), keep=("page_id",), want=("anchors",))
    first = dedupe.keep_first(extract.anchors(parsed, ("page_id",)), ["page_id", "url"], ["pos"])
    return first.select("page_id", F.col("pos").cast("long").alias("pos"), "url")


_LIKES = " OR ".join(f"contains(lower(href), '{p}')" for p in rules.IGNORED_PARTS)
_IS_DOC = "lower(href) LIKE '%documentdownload.ashx%' OR lower(href) LIKE '%.pdf' OR lower(href) LIKE '%.pdf?%'"


@query(f"WITH {_ANCHORS}, l AS (SELECT page_id, pos, href FROM r UNION ALL SELECT page_id, -1, url FROM pages) SELECT page_id, pos, href, ({_LIKES}) AS ignored, ({_IS_DOC}) AS is_document FROM l")
def anchor_classify(spark, sf_dir):
    """Every link of every page, and the page's own, by kind."""
    return _classified(spark, sf_dir)


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    links = extract.anchors(extract.parse_pages(pages, keep=("page_id",), want=("anchors",)), ("page_id",)).select("page_id", "pos", "href")
    own = pages.select("page_id", F.lit(-1).alias("pos"), F.col("page_url").alias("href"))
    href = F.col("href")
    return links.unionByName(own).select("page_id", F.col("pos").cast("long").alias("pos"), "href", U.is_ignored_link(href).alias("ignored"), U.is_document_link(href).alias("is_document"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return _classified(spark, sf_dir)


@query(
    r"""SELECT page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query, regexp_extract(url, '#(.*)$', 1) AS fragment,
    nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '') AS page_arg,
    len(string_split(rtrim(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/'), '/')) >= 2 AS content FROM pages"""
)
def url_parts(spark, sf_dir):
    """The parts of every page's URL."""
    rows = _pages(spark, sf_dir).select("page_id", U.url_parts("page_url").alias("p"), U.query_map("page_url").alias("q"))
    return rows.select("page_id", "p.host", "p.path", "p.query", "p.fragment", F.try_element_at("q", F.lit("page")).alias("page_arg"), U.has_content_path(F.col("p.path")).alias("content"))


@query("SELECT page_id, 0::BIGINT AS articles, 0::BIGINT AS documents, 1::BIGINT AS max_page FROM pages")
def empty_extraction(spark, sf_dir):
    """Pages without article, document or pager links: none is found."""
    p = extract.parse_pages(_pages(spark, sf_dir), keep=("page_id",), want=("articles", "documents", "pager"))
    return p.select("page_id", F.size("parsed.articles").cast("long").alias("articles"), F.size("parsed.documents").cast("long").alias("documents"), F.col("parsed.pager.max_page").cast("long").alias("max_page"))


# ------------------------------------------------------------------ functions


def _sql_sanitize(x: str) -> str:
    unsafe = " || ".join(f"chr({ord(c)})" for c in rules.UNSAFE_CHARACTERS if c != "\0")
    clean = f"trim(regexp_replace(translate({x}, {unsafe}, '{'_' * (len(rules.UNSAFE_CHARACTERS) - 1)}'), '{rules.SPACES}+', ' ', 'g'), ' ._')"
    return f"(SELECT CASE WHEN strlen(c) > 180 THEN regexp_replace(substr(s, 1, 150), '^[ ._]+|[ ._]+$', '', 'g') || e ELSE c END FROM (SELECT c, e, left(c, length(c) - length(e)) AS s FROM (SELECT c, regexp_extract(c, '^.+(\\.[^.]*)$', 1, 's') AS e FROM (SELECT CASE WHEN k = '' THEN 'unnamed_document' ELSE k END AS c FROM (SELECT {clean} AS k)))))"


@query(f"SELECT doc_id, {_sql_sanitize('text')} AS whole, {_sql_sanitize('left(text, 170)')} AS short FROM documents")
def sanitized_names(spark, sf_dir):
    """Every text, and its first 170 characters, as a file name."""
    return _t(spark, sf_dir, "documents").select("doc_id", sanitize_filename(F.col("text")).alias("whole"), sanitize_filename(F.substring("text", 1, 170)).alias("short"))


@query(
    """WITH d AS (SELECT o_orderkey AS k, c_name, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey::VARCHAR END AS id FROM orders JOIN customer ON o_custkey = c_custkey),
    n AS (SELECT k, id, CASE k % 6 WHEN 0 THEN 'r ' || k || '.pdf' WHEN 1 THEN 'ré' || k WHEN 2 THEN 'o ' || k || '.PDF' WHEN 3 THEN 'Link ' || k || '.pdf' WHEN 4 THEN c_name || '.pdf' ELSE 'document_' || coalesce(id, 'doc') || '.pdf' END AS raw FROM d),
    e AS (SELECT k, id, raw || CASE WHEN lower(raw) LIKE '%.pdf' THEN '' ELSE '.pdf' END AS name FROM n)
    SELECT k AS o_orderkey, CASE WHEN id IS NULL THEN name ELSE 'doc_' || id || '_' || name END AS filename FROM e"""
)
def filenames(spark, sf_dir):
    """A file name for every order's document, by each way to find one."""
    k = F.col("o_orderkey")
    rows = _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    kind = k % 6
    header = F.when(kind == 0, F.format_string('attachment; filename="r %d.pdf"', k)).when(kind == 1, F.format_string("inline; filename*=UTF-8''r%%C3%%A9%d", k))
    url = F.when(kind == 2, F.format_string("https://s.example/a/o%%20%d.PDF", k)).otherwise("https://s.example/get")
    text = F.when(kind == 3, F.format_string(" Link %d", k)).otherwise("x")
    title = F.when(kind <= 4, F.col("c_name")).otherwise("")
    id_ = F.when(k % 2 == 0, k.cast("string"))
    return rows.select("o_orderkey", derive_filename(id_, url, text, title, header).alias("filename"))


@query(
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'a b' || doc_id || '+%zz.pdf' WHEN 1 THEN 'é' || doc_id || '.pdf' WHEN 2 THEN 'x' || doc_id ELSE NULL END AS name, 'p+q ' || doc_id || '%' AS decoded FROM documents"""
)
def content_disposition(spark, sf_dir):
    """Names out of headers: extended, damaged by a wrong charset, bare, none."""
    k = F.col("doc_id")
    header = F.when(k % 4 == 0, F.format_string("x; filename*=utf-8''a%%20b%d+%%zz.pdf; y", k)).when(k % 4 == 1, F.format_string('filename="Ã©%d.pdf"', k)).when(k % 4 == 2, F.format_string("filename = x%d;", k)).otherwise("inline")
    return _t(spark, sf_dir, "documents").select("doc_id", decode_content_disposition(header).alias("name"), percent_decode(F.format_string("p+q%%20%d%%", k)).alias("decoded"))


@query("SELECT doc_id, trim(string_split(lang || ' ' || source || ' - ' || doc_id, '-')[1]) AS title, CASE WHEN doc_id % 3 = 0 THEN 'doc_' || doc_id ELSE 'https://s.example/' || doc_id END AS doc_key, CASE WHEN doc_id % 5 = 0 THEN '' ELSE lang END AS link_text, CASE WHEN doc_id % 2 = 0 THEN source ELSE lang END AS carried FROM documents")
def scalar_rules(spark, sf_dir):
    """Title before the hyphen, registry key, generic link text, carried title."""
    k = F.col("doc_id")
    return _t(spark, sf_dir, "documents").select(
        "doc_id", before_hyphen(F.concat_ws(" ", "lang", "source", F.lit("-"), k.cast("string"))).alias("title"),
        U.doc_key(F.when(k % 3 == 0, k.cast("string")).otherwise(F.when(k % 3 == 1, F.lit(""))), F.format_string("https://s.example/%d", k)).alias("doc_key"),
        extract.informative_text(F.when(k % 5 == 0, F.lit("Read More")).otherwise(F.col("lang"))).alias("link_text"),
        extract.carried_title(F.when(k % 2 == 0, F.col("source")).otherwise(""), F.col("lang")).alias("carried"),
    )


# ------------------------------------------------------------------ site

_ART = "art AS (SELECT n_regionkey AS section_ord, c_custkey, c_name, c_nationkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY c_custkey) - 1 AS p FROM customer JOIN nation ON c_nationkey = n_nationkey)"
_URL = "CASE WHEN page_num = 1 THEN 'https://site.example/sec' || section_ord ELSE 'https://site.example/sec' || section_ord || '/PgrID/' || (section_ord + 100) || '/PageID/' || page_num END"


@query("SELECT r_regionkey AS section_ord, 'sec' || r_regionkey AS section_key, r_name AS name, 'https://site.example/sec' || r_regionkey AS start_url FROM region WHERE r_regionkey = 3")
def section_catalog(spark, sf_dir):
    """One section of the catalog by its key."""
    return listing.select_sections(site.catalog(spark, sf_dir), "sec3").select("section_ord", "section_key", "name", "start_url")


def _pagers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = site.listings(spark, sf_dir).where("page_num = 1")
    return extract.pager_info(extract.parse_pages(first, keep=("section_key",), want=("pager",)), ("section_key",))


@query(f"WITH {_ART}, m AS (SELECT section_ord, max(p // 10) + 1 AS n FROM art GROUP BY 1) SELECT 'sec' || section_ord AS section_key, CASE WHEN n > 1 THEN '/sec' || section_ord || '/PgrID/' || (section_ord + 100) || '/PageID/{{page}}' END AS template, CASE WHEN n > 1 THEN n ELSE 1 END AS max_page FROM m")
def pager_info(spark, sf_dir):
    """Template and number of pages that the first page of each section shows."""
    return _pagers(spark, sf_dir).select("section_key", "template", F.col("max_page").cast("long").alias("max_page"))


def _plan_sql(limit: str) -> str:
    return f"WITH {_ART}, m AS (SELECT section_ord, least(max(p // 10) + 1, {limit}) AS n FROM art GROUP BY 1), g AS (SELECT section_ord, unnest(generate_series(1, n)) AS page_num FROM m) SELECT 'sec' || section_ord AS section_key, page_num, {_URL} AS page_url FROM g"


@query(_plan_sql("1000000"))
def listing_plan(spark, sf_dir):
    """All listing pages of all sections."""
    return listing.plan_listing(site.catalog(spark, sf_dir), _pagers(spark, sf_dir)).select("section_key", F.col("page_num").cast("long").alias("page_num"), "page_url")


@query(_plan_sql("3"))
def listing_plan_capped(spark, sf_dir):
    """At most three listing pages of each section: the page cap."""
    return listing.plan_listing(site.catalog(spark, sf_dir), _pagers(spark, sf_dir), 3).select("section_key", F.col("page_num").cast("long").alias("page_num"), "page_url")


_LISTED = f"WITH {_ART}, g AS (SELECT *, p // 10 + 1 AS page_num, row_number() OVER (PARTITION BY section_ord, p // 10 ORDER BY p) - 1 AS pos FROM art WHERE c_custkey % 7 <> 0)"


@query(f"{_LISTED} SELECT {_URL} AS page_url, pos, 'https://site.example/detail/' || c_custkey AS url, c_name AS title, 'D' || c_nationkey AS date FROM g")
def article_links(spark, sf_dir):
    """Article links of all listing pages with article elements."""
    links = extract.article_links(extract.parse_pages(site.listings(spark, sf_dir), want=("articles",)))
    return links.select("page_url", F.col("pos").cast("long").alias("pos"), "url", "title", "date")


@query(f"{_LISTED} SELECT {_URL} AS page_url, pos, 'https://site.example/detail/' || c_custkey AS url, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS title, '' AS date FROM g")
def article_links_fallback(spark, sf_dir):
    """Article links of all listing pages with boxes of another layout."""
    links = extract.article_links(extract.parse_pages(site.listings(spark, sf_dir, cards=False), want=("articles",)))
    return links.select("page_url", F.col("pos").cast("long").alias("pos"), "url", "title", "date")


_DOCS = """doc AS (SELECT o_custkey, o_orderkey AS o, o_orderkey % 7 AS kind, c_name, 'https://site.example' || CASE o_orderkey % 7
  WHEN 0 THEN '/DocumentDownload.ashx?DocumentId=' || o_orderkey || '&ArticleId=' || o_custkey WHEN 1 THEN '/files/order_' || o_orderkey || '.pdf'
  WHEN 2 THEN '/files/o' || o_orderkey || '.pdf?v=1&moduleid=' || (o_orderkey % 5) WHEN 3 THEN '/embed/' || o_orderkey || '.pdf'
  WHEN 4 THEN '/DocumentDownload.ashx?DOCUMENTID=' || o_orderkey ELSE '/obj/' || o_orderkey || '.PDF?x' END AS url
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_custkey % 17 <> 0 AND o_orderkey % 7 <> 5)"""


@query(
    f"""WITH {_DOCS} SELECT 'https://site.example/detail/' || o_custkey AS article_url, row_number() OVER (PARTITION BY o_custkey ORDER BY (kind IN (3, 6)), o) - 1 AS pos, url AS download_url,
    CASE kind WHEN 0 THEN 'Doc ' || o WHEN 1 THEN 'Order' || o WHEN 2 THEN 'x' WHEN 4 THEN 'A' ELSE 'Embedded Document' END AS link_text,
    CASE WHEN kind IN (0, 4) THEN o::VARCHAR END AS document_id, CASE WHEN kind = 0 THEN o_custkey::VARCHAR END AS article_id, CASE WHEN kind = 2 THEN (o % 5)::VARCHAR END AS module_id,
    CASE WHEN o_custkey % 5 = 0 THEN trim(string_split(c_name, '-')[1]) WHEN c_name LIKE '%zz%' THEN '' ELSE c_name END AS article_title FROM doc"""
)
def document_links(spark, sf_dir):
    """Document links of all article pages: anchors first, then embedded ones."""
    links = extract.document_links(extract.parse_pages(site.article_pages(spark, sf_dir), want=("documents",)), ())
    return links.select("article_url", F.col("pos").cast("long").alias("pos"), "download_url", "link_text", "document_id", "article_id", "module_id", "article_title")


@query(
    f"WITH {_ART}, {_DOCS}, v AS (SELECT * FROM art WHERE c_custkey % 7 <> 0), n AS (SELECT o_custkey, count(*) AS n FROM doc GROUP BY 1) SELECT 'sec' || a.section_ord AS section_key, count(DISTINCT a.p // 10) AS listing_pages, count(v.c_custkey) AS articles, coalesce(sum(CASE WHEN v.c_custkey IS NOT NULL THEN n.n END), 0)::BIGINT AS documents FROM art a LEFT JOIN v USING (c_custkey) LEFT JOIN n ON n.o_custkey = v.c_custkey GROUP BY 1"
)
def discovery_counts(spark, sf_dir):
    """A dry run: listing pages, articles and documents of each section."""
    parsed = extract.parse_pages(site.listings(spark, sf_dir), keep=("section_key", "page_num"), want=("articles",))
    arts = extract.article_links(parsed, ("section_key", "page_num"))
    found = extract.parse_pages(site.article_pages(spark, sf_dir), want=("documents",)).select("page_url", F.size("parsed.documents").alias("n"))
    by_article = arts.join(found, arts["url"] == found["page_url"], "left").groupBy("section_key").agg(F.count("*").alias("articles"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("documents"))
    pages = parsed.groupBy("section_key").agg(F.count("*").alias("listing_pages"))
    return pages.join(by_article, "section_key", "left").select("section_key", "listing_pages", F.coalesce("articles", F.lit(0)).alias("articles"), F.coalesce("documents", F.lit(0)).alias("documents"))


# ------------------------------------------------------------------ registry and run


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("o_orderkey")
    orders = _t(spark, sf_dir, "orders")
    candidates = orders.select(k, U.doc_key(k.cast("string"), F.lit("u")).alias("doc_key"))
    path = F.when(k % 20 == 13, F.lit("")).otherwise(F.format_string("s/%d.pdf", k))
    known = orders.where(k % 10 == 3).select(U.doc_key(k.cast("string"), F.lit("u")).alias("doc_key"), F.when(k % 30 == 3, "failed").otherwise("success").alias("status"), path.alias("file_path"))
    files = orders.where(k % 4 != 1).select(F.format_string("s/%d.pdf", k).alias("path"), F.when(k % 50 == 43, F.lit(0)).otherwise(F.lit(13)).cast("long").alias("length"))
    return registry.split_downloaded(candidates, known, files)


_KNOWN = "o_orderkey % 10 = 3 AND o_orderkey % 30 <> 3 AND o_orderkey % 20 <> 13 AND o_orderkey % 4 <> 1 AND o_orderkey % 50 <> 43"


@query(f"SELECT o_orderkey FROM orders WHERE {_KNOWN}")
def already_downloaded(spark, sf_dir):
    """Candidates that the registry and the files know."""
    return _split(spark, sf_dir)[0].select("o_orderkey")


@query(f"SELECT o_orderkey FROM orders WHERE NOT ({_KNOWN})")
def to_fetch(spark, sf_dir):
    """Candidates that are still to be fetched."""
    return _split(spark, sf_dir)[1].select("o_orderkey")


_LOG = f"""{_ART}, rows AS (SELECT DISTINCT section_ord, p // 10 AS pg, -1 AS art, -1 AS doc, 'page' AS kind, NULL AS st, NULL AS price FROM art
 UNION ALL SELECT section_ord, p // 10, c_custkey, -1, 'article', NULL, NULL FROM art
 UNION ALL SELECT section_ord, p // 10, c_custkey, o_orderkey, 'document', o_orderstatus, o_totalprice FROM art JOIN orders ON o_custkey = c_custkey),
 log AS (SELECT row_number() OVER (ORDER BY section_ord, pg, art, doc) AS seq, section_ord, kind, CASE WHEN kind = 'document' THEN 'doc_' || (doc // 3) END AS doc_key,
 (st = 'O' OR (st = 'P' AND doc % 2 = 0)) AS ok, CASE WHEN st = 'P' AND doc % 2 = 0 THEN 0 ELSE trunc(price)::BIGINT END AS size, (doc // 3) % 10 = 3 AS known FROM rows),
 first_ok AS (SELECT doc_key, min(seq) FILTER (ok AND size > 0) AS done FROM log WHERE kind = 'document' GROUP BY 1),
 acted AS (SELECT log.*, coalesce(known OR seq > done, known, false) AND kind = 'document' AS skipped FROM log LEFT JOIN first_ok USING (doc_key))"""
_ACTION = "CASE WHEN kind <> 'document' THEN 'visited' WHEN skipped THEN 'skipped' WHEN ok THEN 'downloaded' ELSE 'failed' END"
_CUT = f"cut AS (SELECT seq AS last FROM acted WHERE kind = 'document' AND ok AND NOT skipped ORDER BY seq LIMIT 1 OFFSET {LIMIT - 1})"
_COUNT = """count(*) FILTER (kind = 'page') AS listing_pages_crawled, count(*) FILTER (kind = 'article') AS articles_visited, count(*) FILTER (kind = 'document') AS pdfs_discovered,
 count(*) FILTER (kind = 'document' AND ok AND NOT skipped) AS pdfs_downloaded, count(*) FILTER (skipped) AS pdfs_skipped, count(*) FILTER (kind = 'document' AND NOT skipped AND NOT ok) AS pdfs_failed"""


@query(f"WITH {_LOG} SELECT seq, doc_key, skipped FROM acted WHERE kind = 'document'")
def in_run_skip(spark, sf_dir):
    """Documents of a run that an earlier one of the same key makes needless."""
    return outcome.in_run_skips(site.log(spark, sf_dir)).where("kind = 'document'").select("seq", "doc_key", "skipped")


@query(f"WITH {_LOG}, {_CUT} SELECT seq, kind, {_ACTION} AS action FROM acted WHERE seq <= coalesce((SELECT last FROM cut), seq)")
def limited_run(spark, sf_dir):
    """What a run comes to before its limit of downloads."""
    return outcome.resolve_run(site.log(spark, sf_dir), LIMIT).select("seq", "kind", "action")


@query(f"WITH {_LOG} SELECT {_COUNT} FROM acted")
def run_summary(spark, sf_dir):
    """The counters of a whole run."""
    return outcome.counters(outcome.resolve_run(site.log(spark, sf_dir)))


@query(f"WITH {_LOG}, {_CUT} SELECT {_COUNT} FROM acted WHERE seq <= coalesce((SELECT last FROM cut), seq)")
def limited_summary(spark, sf_dir):
    """The counters of a run with a limit."""
    return outcome.counters(outcome.resolve_run(site.log(spark, sf_dir), LIMIT))


@query(f"WITH {_LOG} SELECT count(*) FILTER (kind = 'page') AS listing_pages_crawled, count(*) FILTER (kind = 'article') AS articles_visited, count(*) FILTER (kind = 'document') AS pdfs_discovered, 0::BIGINT AS pdfs_downloaded, count(*) FILTER (kind = 'document' AND known) AS pdfs_skipped, 0::BIGINT AS pdfs_failed FROM log")
def dry_run_summary(spark, sf_dir):
    """The counters of a dry run with a limit, which never fires."""
    return outcome.counters(outcome.resolve_run(site.log(spark, sf_dir), LIMIT, dry_run=True))


_STATUS = "CASE event_type WHEN 'click' THEN 'skipped' WHEN 'purchase' THEN 'success' ELSE 'failed' END"
_LATEST = f"e AS (SELECT user_id, event_id, ts, {_STATUS} AS status FROM events), o AS (SELECT user_id, max(CASE WHEN status = 'skipped' THEN 0 ELSE 1 END) AS other FROM e GROUP BY 1), c AS (SELECT e.*, row_number() OVER (PARTITION BY e.user_id ORDER BY CASE WHEN other = 1 AND status = 'skipped' THEN 1 ELSE 0 END, CASE WHEN other = 1 THEN -epoch_us(ts) ELSE epoch_us(ts) END, CASE WHEN other = 1 THEN -event_id ELSE event_id END) AS rn FROM e JOIN o USING (user_id))"


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "click", "skipped").when(F.col("event_type") == "purchase", "success").otherwise("failed")
    events = _t(spark, sf_dir, "events").select("user_id", "event_id", "ts", status.alias("status"))
    return registry.current(events, "user_id", order=("ts", "event_id"))


@query(f"WITH {_LATEST} SELECT user_id, event_id, status FROM c WHERE rn = 1")
def registry_latest(spark, sf_dir):
    """The current entry of each key of a log of events."""
    return _entries(spark, sf_dir).select("user_id", "event_id", "status")


@query(f"WITH {_LATEST} SELECT count(*) AS total_tracked, count(*) FILTER (status = 'success') AS successful_downloads, count(*) FILTER (status = 'failed') AS failed_downloads, count(*) FILTER (status = 'skipped') AS skipped FROM c WHERE rn = 1")
def registry_summary(spark, sf_dir):
    """The current entries by status."""
    return registry.summary(_entries(spark, sf_dir))


@query("SELECT page_id AS id, 'page' AS kind, regexp_matches(html, '^[ \\t\\n\\r\\x0b\\f]*(<!DOCTYPE|<html)') AS is_html FROM pages UNION ALL SELECT doc_id, 'document', regexp_matches(text, '^[ \\t\\n\\r\\x0b\\f]*(<!DOCTYPE|<html)') FROM documents")
def html_sniff(spark, sf_dir):
    """Bodies that are HTML instead of a document."""
    pages = _t(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.lit("page").alias("kind"), F.col("html").alias("body"))
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("document").alias("kind"), F.col("text").alias("body"))
    return pages.unionByName(docs).select("id", "kind", responses.is_html(F.col("body").cast("binary")).alias("is_html"))


@query(
    """WITH r AS (SELECT o_orderkey AS k, o_orderstatus AS st FROM orders)
    SELECT k AS o_orderkey, CASE WHEN k % 11 = 0 OR st = 'F' THEN false WHEN k % 6 = 0 THEN true WHEN st = 'P' THEN false ELSE true END AS ok,
    CASE WHEN k % 11 = 0 OR st = 'F' THEN 0 WHEN k % 6 = 0 THEN 77 WHEN st = 'P' THEN 0 WHEN k % 5 = 0 THEN 0 ELSE strlen('%PDF ' || k) END::BIGINT AS size,
    CASE WHEN k % 11 = 0 THEN 'timeout' WHEN st = 'F' THEN 'HTTP 503' WHEN k % 6 = 0 THEN NULL WHEN st = 'P' THEN 'Server returned HTML error page instead of PDF' END AS error FROM r"""
)
def fetch_outcomes(spark, sf_dir):
    """What responses of all kinds make of a download."""
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    status = F.when(st == "F", 503).otherwise(200)
    body = F.when(st == "P", F.lit("  <!DOCTYPE html>")).when(k % 5 == 0, F.lit("")).otherwise(F.format_string("%%PDF %d", k)).cast("binary")
    existing = F.when(k % 6 == 0, F.lit(77)).otherwise(F.lit(0)).cast("long")
    done = responses.outcome(status, body, F.when(k % 11 == 0, F.lit("timeout")), existing)
    return _t(spark, sf_dir, "orders").select(k, done.alias("d")).select("o_orderkey", "d.ok", "d.size", "d.error")


@query(
    """SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 3 = 0 THEN 'u/' || o_orderkey ELSE 'doc_' || o_orderkey END AS doc_key, 's' || (o_orderkey % 5) AS section,
    CASE WHEN ok THEN 'f' || o_orderkey || '.pdf' ELSE '' END AS filename, CASE WHEN ok THEN 's' || (o_orderkey % 5) || '/f' || o_orderkey || '.pdf' ELSE '' END AS file_path,
    CASE WHEN ok THEN trunc(o_totalprice)::BIGINT ELSE 0 END AS file_size_bytes, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderpriority END AS article_title,
    CASE WHEN ok THEN 'success' ELSE 'failed' END AS status, CASE WHEN ok THEN NULL WHEN o_orderkey % 4 = 0 THEN 'Unknown error' ELSE 'e' || o_orderstatus END AS error
    FROM (SELECT *, o_orderstatus = 'O' AS ok FROM orders)"""
)
def registry_events(spark, sf_dir):
    """Events of downloads that went well and of such that failed."""
    k, ok = F.col("o_orderkey"), F.col("o_orderstatus") == "O"
    rows = _t(spark, sf_dir, "orders").select(
        k.alias("seq"), U.doc_key(F.when(k % 3 != 0, k.cast("string")), F.format_string("u/%d", k)).alias("doc_key"), k.cast("string").alias("document_id"), F.lit(None).cast("string").alias("article_id"),
        F.format_string("s%d", k % 5).alias("section"), F.format_string("f%d.pdf", k).alias("filename"), F.col("o_totalprice").cast("long").alias("file_size_bytes"),
        F.when(k % 2 == 1, F.col("o_orderpriority")).alias("article_title"), F.lit("a").alias("article_url"), F.lit("d").alias("download_url"), F.lit(None).cast("string").alias("link_text"),
        F.when(k % 4 != 0, F.concat(F.lit("e"), "o_orderstatus")).alias("error"), ok.alias("ok"),
    )
    events = registry.success_events(rows.where("ok")).unionByName(registry.failure_events(rows.where("not ok")))
    return events.select("seq", "doc_key", "section", "filename", "file_path", "file_size_bytes", "article_title", "status", "error")


_DISCOVERY = f"""WITH {_ART}, {_DOCS}, s AS (SELECT *, p // 10 AS pg FROM art),
    rows AS (SELECT DISTINCT section_ord, pg, -1 AS art, -1 AS pos, 'page' AS kind, NULL AS url, NULL AS id FROM s
     UNION ALL SELECT section_ord, pg, c_custkey, -1, 'article', NULL, NULL FROM s WHERE c_custkey % 7 <> 0
     UNION ALL SELECT section_ord, pg, c_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY (kind IN (3, 6)), o), 'document', url, CASE WHEN kind IN (0, 4) THEN o::VARCHAR END FROM s JOIN doc ON o_custkey = c_custkey WHERE c_custkey % 7 <> 0)
    SELECT row_number() OVER (ORDER BY section_ord, pg, art, pos) AS seq, kind, 'sec' || section_ord AS section, CASE WHEN kind = 'document' THEN coalesce('doc_' || id, url) END AS doc_key FROM rows"""


@query(_DISCOVERY)
def crawl_discovery(spark, sf_dir):
    """The log of a whole discovery: listing pages, articles and documents, fetched out of a table, in the order of a crawl."""
    return _crawl(spark, sf_dir).discover().select("seq", "kind", "section", "doc_key")


@query(_DISCOVERY)
def streamed_crawl(spark, sf_dir):
    """The log of a crawl that runs as a stream of batches of its frontier, is left after two of them and taken up again by another object."""
    from ..sources.fetch import TableFetcher
    from ..streaming.crawl_stream import CrawlStream

    crawl = _crawl(spark, sf_dir)
    # Each batch asks the site anew, so its pages are made once, in the order of their URLs.
    site_at = f"{crawl.work}/site"
    crawl.fetcher.responses.repartitionByRange("url").sortWithinPartitions("url").write.parquet(site_at)
    crawl.fetcher = TableFetcher(spark.read.schema(crawl.fetcher.responses.schema).parquet(site_at), ordered=True)
    CrawlStream(crawl, f"{crawl.work}/stream", 1000).run(batches=2)
    again = CrawlStream(crawl, f"{crawl.work}/stream", 100_000)
    again.run()
    delete(spark, site_at)
    return again.log().select("seq", "kind", "section", "doc_key")


def _crawl(spark: SparkSession, sf_dir: str, status=None, more: DataFrame | None = None, dry_run: bool = True, **options):
    """A crawl of the site out of a table; status: of the response to a URL; more: further responses."""
    from ..sources.fetch import TableFetcher
    from .crawl import Crawl

    pages = site.listings(spark, sf_dir).select("page_url", "html").unionByName(site.article_pages(spark, sf_dir).select("page_url", "html"))
    utf8 = F.create_map(F.lit("content-type"), F.lit("text/html; charset=utf-8"))
    answers = pages.select(F.col("page_url").alias("url"), (F.lit(200) if status is None else status).alias("status"), utf8.alias("headers"), F.col("html").cast("binary").alias("body"), F.lit(None).cast("string").alias("error"))
    work = _folder(spark)
    if more is not None:
        answers = answers.unionByName(more)
    return Crawl(spark, site.catalog(spark, sf_dir), TableFetcher(answers), registry.Registry(spark, f"{work}/registry"), f"{work}/output", work, dry_run=dry_run, **options)


_GONE = "(SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN 404 WHEN c_custkey % 13 = 0 THEN 500 END AS st FROM customer)"


@query(
    f"""WITH {_ART}, page AS (SELECT DISTINCT section_ord, p // 10 + 1 AS page_num FROM art), lost AS (SELECT * FROM page WHERE page_num > 1 AND page_num % 4 = 0)
    SELECT 'sec' || section_ord AS section_key, {_URL} AS page_url, 'HTTP 503' AS error FROM lost
    UNION ALL SELECT 'sec' || section_ord, 'https://site.example/detail/' || c_custkey, 'HTTP ' || st FROM art JOIN {_GONE} ON k = c_custkey
    WHERE st IS NOT NULL AND c_custkey % 7 <> 0 AND NOT (p // 10 + 1 > 1 AND (p // 10 + 1) % 4 = 0)"""
)
def crawl_failures(spark, sf_dir):
    """Listing pages and articles whose fetch fails are left out of a crawl and reported."""
    page, article = F.regexp_extract("page_url", "PageID/([0-9]+)$", 1), F.regexp_extract("page_url", "detail/([0-9]+)$", 1).try_cast("long")
    status = F.when(page.try_cast("int") % 4 == 0, 503).when(article % 11 == 0, 404).when(article % 13 == 0, 500).otherwise(200)
    crawl = _crawl(spark, sf_dir, status)
    crawl.discover()
    return crawl.failed_pages


@query(
    f"""WITH {_ART}, {_DOCS}, s AS (SELECT * FROM art WHERE section_ord = 3), n AS (SELECT count(DISTINCT p // 10) AS pages, count(*) FILTER (c_custkey % 7 <> 0) AS arts FROM s),
    d AS (SELECT count(*) AS docs FROM s JOIN doc ON o_custkey = c_custkey WHERE c_custkey % 7 <> 0)
    SELECT step, rows::BIGINT AS rows FROM (SELECT 'first pages' AS step, 1 AS rows UNION ALL SELECT 'listing pages', pages - 1 FROM n UNION ALL SELECT 'articles', arts FROM n
    UNION ALL SELECT 'article pages', arts FROM n UNION ALL SELECT 'log', pages + arts + docs FROM n, d)"""
)
def crawl_progress(spark, sf_dir):
    """What the steps of a crawl of one section report as they are done."""
    crawl = _crawl(spark, sf_dir)
    crawl.discover("sec3")
    return spark.createDataFrame([(p["step"], p["rows"]) for p in crawl.progress], "step string, rows long")


# ------------------------------------------------------------------ registry and files, written and read again


def _folder(spark: SparkSession) -> str:
    """A new folder for what a query writes."""
    return f"{shared_dir(spark)}/query-{uuid.uuid4().hex}"


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of orders, of which those with status O went well."""
    k, ok = F.col("o_orderkey"), F.col("o_orderstatus") == "O"
    rows = _t(spark, sf_dir, "orders").select(
        k.alias("seq"), F.format_string("doc_%d", F.floor(k / 2)).alias("doc_key"), k.cast("string").alias("document_id"), F.lit(None).cast("string").alias("article_id"),
        F.format_string("s%d", k % 5).alias("section"), F.format_string("ሕግ, \"%d\".pdf", k).alias("filename"), F.col("o_totalprice").cast("long").alias("file_size_bytes"),
        F.col("o_orderpriority").alias("article_title"), F.lit("a").alias("article_url"), F.lit("d").alias("download_url"), F.lit("line\nbreak").alias("link_text"),
        F.lit("e").alias("error"), ok.alias("ok"),
    )
    return registry.success_events(rows.where("ok")).unionByName(registry.failure_events(rows.where("not ok")))


_OUTCOMES = """o AS (SELECT o_orderkey AS k, o_orderkey // 2 AS half, o_orderstatus = 'O' AS ok, trunc(o_totalprice)::BIGINT AS price FROM orders),
 last AS (SELECT half, max(k) AS k, min(k) AS seen FROM o GROUP BY half), now AS (SELECT o.*, seen FROM o JOIN last USING (half, k))"""
_ENTRY = """'doc_' || half AS doc_key, 's' || (k % 5) AS section, CASE WHEN ok THEN 'ሕግ, "' || k || '".pdf' ELSE '' END AS filename, CASE WHEN ok THEN price ELSE 0 END AS file_size_bytes, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status"""


@query(f"WITH {_OUTCOMES} SELECT row_number() OVER (ORDER BY seen) - 1 AS place, {_ENTRY} FROM now")
def registry_json(spark, sf_dir):
    """The current entries of a registry after its JSON form has been written and read again, in their order."""
    at = _folder(spark)
    store = registry.Registry(spark, f"{at}/registry")
    store.append(_outcomes(spark, sf_dir))
    store.export_json(f"{at}/registry.json")
    return registry.import_json(spark, f"{at}/registry.json").select(F.col("seq").alias("place"), "doc_key", "section", "filename", "file_size_bytes", "status")


@query(f"WITH {_OUTCOMES} SELECT {_ENTRY} FROM now")
def registry_csv(spark, sf_dir):
    """The same after its CSV form has been written and read again."""
    at = _folder(spark)
    store = registry.Registry(spark, f"{at}/registry")
    store.append(_outcomes(spark, sf_dir))
    store.export_csv(f"{at}/registry.csv")
    rows = spark.read.csv(f"{at}/registry.csv", header=True, multiLine=True, escape='"')
    return rows.select(F.col("key").alias("doc_key"), "section", F.coalesce("filename", F.lit("")).alias("filename"), F.col("file_size_bytes").cast("long").alias("file_size_bytes"), "status")


@query(f"WITH {_OUTCOMES} SELECT o.k AS o_orderkey FROM o JOIN now USING (half) WHERE NOT (now.ok AND now.price % 10 <> 0)")
def resumed_run(spark, sf_dir):
    """What is still to be fetched by a run that loads the registry of an earlier one: its file must be there and not empty."""
    at = _folder(spark)
    registry.Registry(spark, f"{at}/registry").append(_outcomes(spark, sf_dir))
    entries = registry.Registry(spark, f"{at}/registry").load()
    files = entries.where("status = 'success'").select(F.col("file_path").alias("path"), F.when(F.col("file_size_bytes") % 10 == 0, 0).otherwise(F.col("file_size_bytes")).alias("length"))
    candidates = _t(spark, sf_dir, "orders").select("o_orderkey", F.format_string("doc_%d", F.floor(F.col("o_orderkey") / 2)).alias("doc_key"))
    return registry.split_downloaded(candidates, entries, files)[1].select("o_orderkey")


@query(f"WITH {_OUTCOMES} SELECT doc_key, section, filename, file_size_bytes, status FROM (SELECT {_ENTRY} FROM now)")
def streamed_registry(spark, sf_dir):
    """The current entries of a registry that two runs of a stream have fed."""
    from ..schemas import EVENT
    from ..streaming.registry_stream import follow

    at = _folder(spark)
    store = registry.Registry(spark, f"{at}/registry")
    events = _outcomes(spark, sf_dir)
    shape = spark.createDataFrame([], EVENT)
    for half in (F.col("seq") % 2 == 0, F.col("seq") % 2 == 1):  # the second event of a key comes in the second run
        events.where(half).select(*shape.columns).to(shape.schema).write.mode("append").parquet(f"{at}/in")
        follow(spark.readStream.schema(EVENT).parquet(f"{at}/in"), store, f"{at}/checkpoint").awaitTermination()
    return store.load().select("doc_key", "section", "filename", "file_size_bytes", "status")


@query(f"WITH {_LATEST}, f AS (SELECT user_id, event_id AS first_event FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1) SELECT user_id, event_id, status, first_event FROM c JOIN f USING (user_id) WHERE rn = 1")
def keyed_state(spark, sf_dir):
    """The current entries of a stream of events, held as its state, over four batches, of which the third brings the events of the first one again."""
    from ..streaming.keyed_state import entries, follow_entries

    at = _folder(spark)
    status = F.when(F.col("event_type") == "click", "skipped").when(F.col("event_type") == "purchase", "success").otherwise("failed")
    events = _t(spark, sf_dir, "events").select("user_id", "event_id", "ts", status.alias("status"))
    for part in (0, 1, 0, 2):
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{at}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{at}/in")
        follow_entries(stream, f"{at}/out", f"{at}/checkpoint", "user_id", order=("ts", "event_id")).awaitTermination()
    return entries(spark, f"{at}/out", "user_id").select("user_id", "event_id", "status", F.col("first_event_id").alias("first_event"))


@query(
    f"""WITH {_OUTCOMES}, j AS (SELECT now.*, ok AND price % 10 <> 0 AS done FROM now)
    SELECT {_ENTRY}, seen, done FROM j"""
)
def merged_registry(spark, sf_dir):
    """The current entries of a registry whose snapshot was made before the second events of its keys came, and whether they count as downloaded."""
    at = _folder(spark)
    store = registry.Registry(spark, f"{at}/registry")
    events = _outcomes(spark, sf_dir)
    store.append(events.where("seq % 2 = 0"))
    store.compact()
    # Numbers are given in the order of the runs, so first_seen is told by the key's least order.
    store.append(events.where("seq % 2 = 1"))
    files = events.where("status = 'success'").select(F.col("file_path").alias("path"), F.when(F.col("file_size_bytes") % 10 == 0, 0).otherwise(F.col("file_size_bytes")).alias("length"))
    seen = events.groupBy("doc_key").agg(F.min("seq").alias("seen"))
    entries = store.load().join(seen, "doc_key")
    done, _ = store.split(entries.select("doc_key"), files)
    return entries.join(done.withColumn("done", F.lit(True)), "doc_key", "left").select("doc_key", "section", "filename", "file_size_bytes", "status", "seen", F.coalesce("done", F.lit(False)).alias("done"))


@query(
    """SELECT c_custkey AS seq, NOT k AS ok, CASE WHEN k THEN '' ELSE 'c' || (c_custkey // 2) || '.pdf' END AS filename,
    CASE WHEN k THEN 0 ELSE first_value(strlen('%PDF ' || c_name)) OVER (PARTITION BY c_nationkey, c_custkey // 2, k ORDER BY c_custkey) END AS file_size_bytes,
    CASE WHEN k THEN 0 ELSE first_value(strlen('%PDF ' || c_name)) OVER (PARTITION BY c_nationkey, c_custkey // 2, k ORDER BY c_custkey) END AS listed
    FROM (SELECT *, c_custkey % 7 = 0 AS k FROM customer) WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0"""
)
def document_results(spark, sf_dir):
    """What the sink for documents reports of each row that it was told to publish, and the length of that row's file by a listing; the rest is rolled back."""
    k = F.col("c_custkey")
    rows = _t(spark, sf_dir, "customer").select(
        k.cast("long").alias("seq"), F.format_string("s%d", "c_nationkey").alias("section"), F.format_string("c%d.pdf", F.floor(k / 2)).alias("filename"), F.when(k % 7 == 0, 503).otherwise(200).alias("status"),
        F.concat(F.lit("%PDF "), "c_name").cast("binary").alias("body"), F.lit(None).cast("string").alias("error"),
    )
    wanted = rows.where("seq % 2 = 0 or seq % 3 = 0")
    at = f"{_folder(spark)}/files"
    done = stage_bodies(rows, at).publish(wanted.select("seq"))
    files = list_files(spark, at).select("path", F.col("length").alias("listed"))
    named = done.join(wanted.select("seq", "section"), "seq").withColumn("path", F.concat_ws("/", "section", "filename"))
    return named.join(files, "path", "full").select("seq", "ok", "filename", "file_size_bytes", F.coalesce("listed", F.lit(0).cast("long")).alias("listed"))


@query(
    f"""WITH {_ART}, {_DOCS}, s AS (SELECT *, p // 10 AS pg FROM art WHERE section_ord = 3),
    rows AS (SELECT DISTINCT pg, -1 AS art, -1 AS pos, 'page' AS kind, NULL::BIGINT AS o, NULL AS url, NULL AS id FROM s
     UNION ALL SELECT pg, c_custkey, -1, 'article', NULL, NULL, NULL FROM s WHERE c_custkey % 7 <> 0
     UNION ALL SELECT pg, c_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY (kind IN (3, 6)), o), 'document', o, url, CASE WHEN kind IN (0, 4) THEN o::VARCHAR END FROM s JOIN doc ON o_custkey = c_custkey WHERE c_custkey % 7 <> 0),
    log AS (SELECT row_number() OVER (ORDER BY pg, art, pos) AS seq, *, kind = 'document' AND o % 5 <> 0 AS ok FROM rows),
    cut AS (SELECT seq AS last FROM log WHERE ok ORDER BY seq LIMIT 1 OFFSET {{RUN - 1}}), run AS (SELECT * FROM log WHERE seq <= coalesce((SELECT last FROM cut), seq))
    SELECT 'document' AS what, coalesce('doc_' || id, url) AS name, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status, CASE WHEN ok THEN strlen('%PDF ' || o) ELSE 0 END AS number FROM run WHERE kind = 'document'
    UNION ALL SELECT 'counter', unnest(['listing_pages_crawled', 'articles_visited', 'pdfs_discovered', 'pdfs_downloaded', 'pdfs_skipped', 'pdfs_failed']), NULL,
     unnest([count(*) FILTER (kind = 'page'), count(*) FILTER (kind = 'article'), count(*) FILTER (kind = 'document'), count(*) FILTER (ok), 0, count(*) FILTER (kind = 'document' AND NOT ok)]) FROM run""".replace("{RUN - 1}", "11")
)
def limited_crawl(spark, sf_dir):
    """A crawl of one section with a limit, to its end: its counters, its registry, and the lengths of the files that it leaves, of which each has an entry."""
    o = F.col("o_orderkey")
    bodies = _t(spark, sf_dir, "orders").select(o, F.explode(site.document_urls(o, F.col("o_custkey"))).alias("url"))
    answers = bodies.select("url", F.when(o % 5 == 0, 404).otherwise(200).alias("status"), F.create_map(F.lit("content-type"), F.lit("application/pdf")).alias("headers"), F.format_string("%%PDF %d", o).cast("binary").alias("body"), F.lit(None).cast("string").alias("error"))
    crawl = _crawl(spark, sf_dir, more=answers, dry_run=False, limit=RUN)
    counts = crawl.run("sec3")
    entries = crawl.store.load().where("doc_key is not null")
    files = list_files(spark, crawl.output)
    made = entries.join(files, F.col("file_path") == F.col("path"), "full").select(F.lit("document").alias("what"), F.col("doc_key").alias("name"), "status", F.coalesce("length", F.lit(0).cast("long")).alias("number"))
    return made.unionByName(spark.createDataFrame([("counter", k, None, v) for k, v in counts.items()], "what string, name string, status string, number long"))


@query("SELECT 's' || n_regionkey || '/n' || n_nationkey || '.pdf' AS path, strlen('%PDF ' || n_name) AS length FROM nation WHERE n_nationkey % 4 <> 1 AND n_nationkey % 4 <> 3")
def written_files(spark, sf_dir):
    """Files that responses have made, by a listing of their folder: neither failures nor HTML pages nor empty files."""
    k = F.col("n_nationkey")
    body = F.when(k % 4 == 1, F.lit("<html>")).when(k % 8 == 3, F.lit("")).otherwise(F.concat(F.lit("%PDF "), "n_name")).cast("binary")
    rows = _t(spark, sf_dir, "nation").select(
        k.cast("long").alias("seq"), F.format_string("s%d", "n_regionkey").alias("section"), F.format_string("n%d.pdf", k).alias("filename"), F.when(k % 8 == 7, 404).otherwise(200).alias("status"), body.alias("body"), F.lit(None).cast("string").alias("error")
    )
    at = f"{_folder(spark)}/files"
    write_documents(rows, local_path(at)).count()
    return list_files(spark, at).where("length > 0").select("path", "length")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
