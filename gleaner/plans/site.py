"""A site made of the business tables, to run the engine on pages whose answers are known.

Sections are regions, articles are customers (ten on a listing page, by key),
documents are their orders.  The kind of a link follows from the order's key, so
what the engine must find can be computed from the rows without any HTML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.outcome import numbered

HOST = "https://site.example"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("r_regionkey")
    return _t(spark, sf_dir, "region").select(
        key.alias("section_ord"), F.format_string("sec%d", key).alias("section_key"), F.col("r_name").alias("name"), F.format_string(f"{HOST}/sec%d", key).alias("start_url"),
        F.when(key % 2 == 0, F.format_string("/sec%d/PgrID/%d/PageID/{page}", key, key + 100)).otherwise("").alias("pager_pattern"),
        F.concat(F.lit("All of "), "r_name").alias("description"),
    )


def articles(spark: SparkSession, sf_dir: str, block: int = 4096) -> DataFrame:
    """section_ord, c_custkey, c_name, c_nationkey, page_num, slot: places by key, ranks within blocks of keys after the totals of the blocks before."""
    rows = _t(spark, sf_dir, "customer").join(_t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select(F.col("n_regionkey").alias("section_ord"), "c_custkey", "c_name", "c_nationkey", F.floor(F.col("c_custkey") / block).alias("_b"))
    totals = rows.groupBy("section_ord", "_b").agg(F.count("*").alias("_n"))
    past = F.coalesce(F.sum("_n").over(Window.partitionBy("section_ord").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("section_ord", "_b").orderBy("c_custkey")) - 1
    placed = rows.withColumn("_own", own).join(totals.select("section_ord", "_b", past.alias("_past")), ["section_ord", "_b"]).withColumn("_p", F.col("_past") + F.col("_own"))
    return placed.select("section_ord", "c_custkey", "c_name", "c_nationkey", (F.floor(F.col("_p") / 10).cast("int") + 1).alias("page_num"), (F.col("_p") % 10).cast("int").alias("slot"))


def listings(spark: SparkSession, sf_dir: str, cards: bool = True) -> DataFrame:
    """section_ord, section_key, page_num, page_url, html: with article elements, or boxes of another layout."""
    k = F.col("c_custkey")
    if cards:
        good = F.format_string('<article class="a"><h3 class="Title"><a href="/detail/%d"> %s</a></h3><i class="pubDate">D%d</i></article>', k, "c_name", "c_nationkey")
        bad = F.format_string('<article><h3 class="title"><a href="/login?x=%d">%s</a></h3></article>', k, "c_name")
    else:
        good = F.format_string('<div class="EDN_box"><a href="/detail/%d">%s</a><a href="/detail/%d">Read more</a></div>', k, F.when(k % 3 == 0, F.lit("View")).otherwise(F.col("c_name")), k)
        bad = F.format_string('<div class="news_item"><a href="/login?x=%d">%s</a><a href="/">Home</a></div>', k, "c_name")
    card = F.when(k % 7 == 0, bad).otherwise(good)
    pages = articles(spark, sf_dir).groupBy("section_ord", "page_num").agg(F.array_sort(F.collect_list(F.struct("slot", card.alias("card")))).alias("_c"))
    pages = pages.join(pages.groupBy("section_ord").agg(F.max("page_num").alias("_last")), "section_ord")
    last = F.col("_last")
    number = F.format_string('<a href="/sec%d/PgrID/%d/PageID/2">2</a><a href="/sec%d/PgrID/%d/PageID/%d">Last</a>', "section_ord", F.col("section_ord") + 100, "section_ord", F.col("section_ord") + 100, last)
    pager = F.when(last > 1, number).otherwise("")
    html = F.concat(F.lit("<html><body>"), F.array_join(F.transform("_c", lambda c: c["card"]), ""), pager, F.lit("</body></html>"))
    key = F.format_string("sec%d", "section_ord")
    url = F.when(F.col("page_num") == 1, F.format_string(f"{HOST}/sec%d", "section_ord")).otherwise(F.format_string(f"{HOST}/sec%d/PgrID/%d/PageID/%d", "section_ord", F.col("section_ord") + 100, "page_num"))
    return pages.select("section_ord", key.alias("section_key"), "page_num", url.alias("page_url"), html.alias("html"))


def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """c_custkey, page_url, html of each article: its orders as links of seven kinds."""
    o = F.col("o_orderkey")
    kinds = [
        F.format_string('<p><a href="/DocumentDownload.ashx?DocumentId=%d&amp;ArticleId=%d">Doc %d</a></p>', o, "o_custkey", o),
        F.format_string('<a href="/files/order_%d.pdf">Order <b>%d</b></a>', o, o),
        F.format_string('<a href="../files/o%d.pdf?v=1&amp;moduleid=%d">x</a>', o, o % 5),
        F.format_string('<iframe src="/embed/%d.pdf"></iframe>', o),
        F.format_string('<a href="/DocumentDownload.ashx?DOCUMENTID=%d">A</a><a href="/DocumentDownload.ashx?DOCUMENTID=%d">B</a>', o, o),
        F.format_string('<a href="/page/%d">x</a>', o),
        F.format_string('<object data="/obj/%d.PDF?x"></object>', o),
    ]
    plain = F.format_string('<a href="/page/%d">x</a>', o)
    kind = F.lit(None)
    for i, link in reversed(list(enumerate(kinds))):
        kind = F.when(o % 7 == i, link).otherwise(kind)
    link = F.when(F.col("o_custkey") % 17 == 0, plain).otherwise(kind)
    docs = _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", link.alias("link")))).alias("_d"))
    body = F.coalesce(F.array_join(F.transform("_d", lambda d: d["link"]), ""), F.lit(""))
    title = F.when(F.col("c_custkey") % 5 == 0, "<h1>Menu</h1><title>%s - site</title>").otherwise("<h1>%s</h1>")
    head = F.replace(title, F.lit("%s"), F.col("c_name"))
    return _t(spark, sf_dir, "customer").join(docs, "c_custkey", "left").select(
        "c_custkey", F.format_string(f"{HOST}/detail/%d", "c_custkey").alias("page_url"), F.concat(F.lit("<html><body>"), head, body, F.lit("</body></html>")).alias("html")
    )


def document_urls(o: Column, customer: Column) -> Column:
    """An array of the URL of an order's document, empty for orders without one."""
    paths = [
        F.format_string("/DocumentDownload.ashx?DocumentId=%d&ArticleId=%d", o, customer), F.format_string("/files/order_%d.pdf", o), F.format_string("/files/o%d.pdf?v=1&moduleid=%d", o, o % 5), F.format_string("/embed/%d.pdf", o),
        F.format_string("/DocumentDownload.ashx?DOCUMENTID=%d", o), F.lit(None), F.format_string("/obj/%d.PDF?x", o),
    ]
    path = F.lit(None)
    for i, p in enumerate(paths):
        path = F.when(o % 7 == i, p).otherwise(path)
    return F.array_compact(F.array(F.concat(F.lit(HOST), path)))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's log: a row for each page, article and document in the order of a crawl.

    Order o is the document ``o_orderkey // 3``, so keys repeat; status O downloads,
    P gives an empty file (a zero size) where its key is even, all else fails.
    """
    a = articles(spark, sf_dir)
    orders = _t(spark, sf_dir, "orders")
    pages = a.select("section_ord", "page_num").distinct().select("section_ord", "page_num", F.lit(-1).cast("long").alias("art"), F.lit(-1).cast("long").alias("doc"), F.lit("page").alias("kind"))
    arts = a.select("section_ord", "page_num", F.col("c_custkey").alias("art"), F.lit(-1).cast("long").alias("doc"), F.lit("article").alias("kind"))
    docs = a.join(orders, F.col("c_custkey") == F.col("o_custkey")).select("section_ord", "page_num", F.col("c_custkey").alias("art"), F.col("o_orderkey").alias("doc"), F.lit("document").alias("kind"), "o_orderstatus", "o_totalprice")
    rows = pages.unionByName(arts).unionByName(docs, allowMissingColumns=True)
    empty = (F.col("o_orderstatus") == "P") & (F.col("doc") % 2 == 0)
    return numbered(rows, ["section_ord", "page_num"], ["art", "doc"]).select(
        "seq", "section_ord", "kind", F.when(F.col("kind") == "document", F.format_string("doc_%d", F.floor(F.col("doc") / 3))).alias("doc_key"),
        ((F.col("o_orderstatus") == "O") | empty).alias("ok"), F.when(empty, F.lit(0)).otherwise(F.col("o_totalprice")).cast("long").alias("size"), (F.floor(F.col("doc") / 3) % 10 == 3).alias("known"),
    )
