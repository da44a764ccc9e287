import threading
from dataclasses import replace
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from gleaner import cli
from gleaner.operators.registry import Registry
from gleaner.plans import site
from gleaner.plans.crawl import Crawl
from gleaner.schemas import CATALOG, EVENT, RESPONSE
from gleaner.sources.fetch import HttpFetcher, Policy, TableFetcher, body_text, chunks, request, write_documents
from gleaner.sources.files import list_files
from gleaner.sources.http import register
from gleaner.sources.live import Ticker, counted
from gleaner.sources.sink import Staged, _move, stage, stage_bodies
from gleaner.sources.turns import by_host, in_turn
from tests.conftest import SMALL

LISTING = '<article><a href="/d/1">One</a></article><article><a href="/d/2">Two</a></article><article><a href="/d/404">Gone</a></article><a href="/direct.pdf">Direct doc</a><a href="/l/PageID/2">2</a>'
SITE = {
    "/l": (200, "text/html; charset=utf-8", LISTING.encode()),
    "/l/PageID/2": (200, "text/html; charset=utf-8", b'<article><a href="/d/3">Three</a></article>'),
    "/d/1": (200, "text/html; charset=utf-8", '<h1>ርዕስ አንድ</h1><a href="/DocumentDownload.ashx?DocumentId=1">D</a><a href="/html.pdf">H</a>'.encode()),
    "/d/2": (200, "text/html; charset=utf-8", b'<a href="/DocumentDownload.ashx?DocumentId=1">D again</a><a href="/empty.pdf">E</a>'),
    "/d/3": (200, "text/html; charset=utf-8", b'<a href="/last.pdf">L</a>'),
    "/direct.pdf": (200, "application/pdf", b"%PDF direct"),
    "/DocumentDownload.ashx?DocumentId=1": (200, "application/pdf", b"%PDF one"),
    "/html.pdf": (200, "text/html", b" <!DOCTYPE html>"),
    "/empty.pdf": (200, "application/pdf", b""),
    "/last.pdf": (200, "application/pdf", b"%PDF last"),
}


@pytest.fixture(scope="module")
def server():
    hits = {}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            hits[self.path] = hits.get(self.path, 0) + 1
            if self.path == "/flaky" and hits[self.path] < 3:
                self.send_response(503)
                self.send_header("Retry-After", "0")
                self.send_header("Content-Length", "0")
                self.end_headers()
                return
            status, kind, body = SITE.get(self.path, (200, "text/plain", b"ok") if self.path == "/flaky" else (404, "text/html", b"gone"))
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(body)))
            if "ashx" in self.path:
                self.send_header("Content-Disposition", "attachment; filename*=UTF-8''%E1%88%95%E1%8C%8D.pdf")
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", hits
    s.shutdown()


POLICY = Policy(delay=0, backoff=0)


def test_retry(server):
    base, hits = server
    waits = []
    r = request(f"{base}/flaky", Policy(backoff=1.5), sleep=waits.append)
    assert r["status"] == 200 and r["body"] == b"ok" and waits == [0.0, 0.0]
    assert Policy().wait(1, None, 500) == 0 and Policy().wait(2, None, 500) == 3 and Policy().wait(3, None, 500) == 6 and Policy().wait(9, None, 500) == 120
    r = request("http://127.0.0.1:9/x", POLICY, sleep=waits.append)
    assert r["status"] is None and r["error"]


def test_data_source(spark, server):
    base, _ = server
    register(spark)
    rows = spark.read.format("gleaner_http").option("urls", f"{base}/l {base}/none").option("delay", "0").load().collect()
    assert {r.url: r.status for r in rows} == {f"{base}/l": 200, f"{base}/none": 404} and rows[0].headers


def test_a_frontier_table_is_planned_without_its_rows(spark, server, tmp_path):
    import tracemalloc

    from gleaner.sources.http import HttpReader

    base, hits = server
    path = str(tmp_path / "frontier")
    spark.range(1_000_000).selectExpr("concat('http://h', id % 1000, '.example/', id) as url").write.parquet(path)
    reader = HttpReader({"path": path, "partitions": "16"})
    tracemalloc.start()
    parts = reader.partitions()
    assert len(parts) == 16 and tracemalloc.get_traced_memory()[1] < 100_000
    tracemalloc.stop()
    some = list(reader.chosen(3))
    assert len(some) == len(set(some)) and 20_000 < len(some) < 120_000
    hits.clear()
    spark.createDataFrame([(f"{base}/d/1",), (f"{base}/d/2",), (f"{base}/d/1",), (None,), (f"{base}/none",)], "url string").write.parquet(str(tmp_path / "few"))
    register(spark)
    read = lambda: spark.read.format("gleaner_http").options(path=str(tmp_path / "few"), delay="0").load()
    assert {r.url for r in read().where("startswith(url, '" + base + "/d/')").where("status = 200").collect()} == {f"{base}/d/1", f"{base}/d/2"}
    assert hits == {"/d/1": 1, "/d/2": 1}
    assert read().where(f"url = '{base}/d/2'").count() == 1 and hits == {"/d/1": 1, "/d/2": 2}
    assert read().count() == 3


def crawl(spark, base, tmp_path, **more):
    catalog = spark.createDataFrame([(0, "sec", "Sec", f"{base}/l", None, "")], CATALOG)
    return Crawl(spark, catalog, HttpFetcher(POLICY), Registry(spark, str(tmp_path / "registry")), str(tmp_path / "out"), str(tmp_path / "work"), **more)


def test_crawl(spark, server, tmp_path):
    base, _ = server
    c = crawl(spark, base, tmp_path)
    assert list(c.run().values()) == [2, 4, 6, 4, 1, 1]
    names = sorted(p.name for p in (tmp_path / "out" / "sec").iterdir())
    assert names == ["direct.pdf", "doc_1_ሕግ.pdf", "empty.pdf", "last.pdf"]
    entries = {r.doc_key: r for r in c.store.load().collect()}
    assert entries["doc_1"].article_title == "ርዕስ አንድ" and entries[f"{base}/html.pdf"].status == "failed" and entries[f"{base}/html.pdf"].filename == ""
    assert entries[f"{base}/empty.pdf"].article_title == "Two" and entries[f"{base}/direct.pdf"].article_url == f"{base}/l"
    # A second run knows what is there, but for the empty file and the failure.
    assert list(c.run().values()) == [2, 4, 6, 1, 4, 1]
    assert [(r.page_url, r.error) for r in c.failed_pages.collect()] == [(f"{base}/d/404", "HTTP 404")]


def test_a_limit_stops_the_requests(spark, server, tmp_path):
    """The first download of a section costs its first page, one article and that document, not the section."""
    base, hits = server
    hits.clear()
    c = crawl(spark, base, tmp_path, limit=1)
    assert c.run()["pdfs_downloaded"] == 1
    assert hits == {"/l": 1, "/direct.pdf": 1}
    hits.clear()
    assert list(crawl(spark, base, tmp_path / "two", limit=2).run().values()) == [1, 1, 2, 2, 0, 0]
    assert hits == {"/l": 1, "/direct.pdf": 1, "/d/1": 1, "/DocumentDownload.ashx?DocumentId=1": 1}
    assert [x["step"] for x in c.progress if x["step"] == "downloads"] == ["downloads"] and c.progress[-1]["ok"] == 1


def test_counts_come_while_a_step_runs(spark, server, tmp_path):
    """One host is one task: its documents are counted before it ends, and the caller's job group stays."""
    base, _ = server
    told = []
    c = crawl(spark, base, tmp_path, on_progress=told.append, every=0.1)
    c.fetcher = HttpFetcher(replace(POLICY, delay=0.4))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", "mine")
    try:
        assert list(c.run().values()) == [2, 4, 6, 4, 1, 1]
        assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == "mine"
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    steps = [x["step"] for x in told]
    last = steps.index("downloads") + steps.count("downloads") - 1
    live = [x for x in told[:last] if x["step"] == "downloads"]
    assert "running" not in told[last] and all(x["running"] for x in live)
    assert any(0 < x["rows"] < told[last]["rows"] and x["tasks_done"] < x["tasks"] for x in live)
    assert [x["rows"] for x in live] == sorted(x["rows"] for x in live) and [x["bytes"] for x in live] == sorted(x["bytes"] for x in live)
    assert any(x.get("running") and x["step"] == "article pages" for x in told)
    assert all("running" not in x for x in c.progress) and not (tmp_path / "out" / "_jobs").exists()


def test_what_an_attempt_says_takes_the_place_of_the_one_before(tmp_path):
    now = [0.0]
    for n in (3, 2):  # the second attempt of partition 7 has come less far
        t = Ticker(str(tmp_path / "job"), 7, lambda: now[0])
        for _ in range(n):
            t.add(True, 10)
            now[0] += 1
    t = Ticker(str(tmp_path / "job"), 8, lambda: now[0])
    t.add(False, 0)
    t.add(True, 5)  # within the same moment, so not said yet
    assert counted(str(tmp_path)) == {"rows": 3, "ok": 2, "bytes": 20}
    t.say()
    assert counted(str(tmp_path)) == {"rows": 4, "ok": 3, "bytes": 25} and counted(str(tmp_path / "none"))["rows"] == 0


def test_parts_of_the_frontier_are_the_whole_log(spark, server, tmp_path):
    base, _ = server
    c = crawl(spark, base, tmp_path)
    whole = c.discover().select("seq", "kind", "doc_key", "page_num").collect()
    parts = [p.select("seq", "kind", "doc_key", "page_num").collect() for p in c.frontier()]
    assert len(parts) == 4 and sorted(map(str, (r for p in parts for r in p))) == sorted(map(str, whole))
    full = list(crawl(spark, base, tmp_path / "f", limit=100).run().values())
    assert full == list(crawl(spark, base, tmp_path / "g").run().values())


def test_a_body_is_read_only_where_its_file_is_missing(spark, server, tmp_path):
    """The name, and whether the file is there, are known from the headers; a key is asked for once."""
    base, hits = server
    c = crawl(spark, base, tmp_path)
    c.run()
    assert hits["/DocumentDownload.ashx?DocumentId=1"] >= 1
    read = []
    answer = lambda: iter([read.append(1) or b"x"])
    assert stage(str(tmp_path / "out"), str(tmp_path / "s"), "sec", "last.pdf", answer) == (True, "last.pdf", 9, None, None) and not read
    hits.clear()
    fresh = Registry(spark, str(tmp_path / "another"))
    again = Crawl(spark, c.catalog, c.fetcher, fresh, c.output, c.work)
    assert list(again.run().values()) == [2, 4, 6, 4, 1, 1]
    assert all(n == 1 for n in hits.values())


def test_documents_of_one_file_come_in_order(spark, tmp_path):
    rows = spark.createDataFrame([(i, "s", "same.pdf", 200, bytearray(f"%PDF {i}".encode()), None) for i in (5, 3, 9, 4)], "seq long, section string, filename string, status int, body binary, error string").repartition(4)
    got = write_documents(rows, str(tmp_path)).collect()
    assert (tmp_path / "s" / "same.pdf").read_bytes() == b"%PDF 3" and all(r.ok and r.file_size_bytes == 6 for r in got)


def test_compressed_bodies_come_in_chunks():
    import gzip
    import io
    import zlib

    body = b"text " * 50_000
    raw = zlib.compressobj(wbits=-15)
    for encoding, sent in (("gzip", gzip.compress(body)), ("deflate", zlib.compress(body)), ("deflate", raw.compress(body) + raw.flush()), (None, body)):
        assert b"".join(chunks(io.BytesIO(sent), encoding, 1000)) == body
    assert list(chunks(io.BytesIO(b""), "gzip")) == []


def test_limits_and_dry_run(spark, server, tmp_path):
    base, _ = server
    assert list(crawl(spark, base, tmp_path, limit=2).run().values()) == [1, 1, 2, 2, 0, 0]
    assert list(crawl(spark, base, tmp_path / "b", dry_run=True).run().values()) == [2, 4, 6, 0, 0, 0]
    assert list(crawl(spark, base, tmp_path / "c", limit=-1).run().values()) == [0] * 6
    assert list(crawl(spark, base, tmp_path / "d", dry_run=True, max_pages=1).run().values()) == [1, 3, 5, 0, 0, 0]


def test_failed_first_page(spark, server, tmp_path):
    base, _ = server
    with pytest.raises(RuntimeError, match="first page"):
        crawl(spark, f"{base}/none", tmp_path).run()
    c = crawl(spark, f"{base}/none", tmp_path, fail_fast=False, dry_run=True)
    assert sum(c.run().values()) == 0 and c.failed_pages.count() == 1


def test_table_fetcher(spark, tmp_path):
    """A dry run of the synthetic site out of a table agrees with the counts of the query."""
    from gleaner.plans import catalog as queries

    pages = site.listings(spark, SMALL).select("page_url", "html").unionByName(site.article_pages(spark, SMALL).select("page_url", "html"))
    answers = pages.selectExpr("page_url as url", "200 as status", "map('content-type', 'text/html; charset=utf-8') as headers", "cast(html as binary) as body", "cast(null as string) as error")
    c = Crawl(spark, site.catalog(spark, SMALL), TableFetcher(answers), Registry(spark, str(tmp_path / "r")), str(tmp_path / "o"), str(tmp_path / "w"), dry_run=True)
    got = c.run()
    want = queries.queries()["discovery_counts"](spark, SMALL).agg({"listing_pages": "sum", "articles": "sum", "documents": "sum"}).first().asDict()
    assert (got["listing_pages_crawled"], got["articles_visited"], got["pdfs_discovered"]) == (want["sum(listing_pages)"], want["sum(articles)"], want["sum(documents)"])


def test_body_text():
    assert body_text("é".encode(), "text/html") == "Ã©" and body_text("é".encode(), "text/html; charset=UTF-8") == "é" == body_text("é".encode(), None)
    assert body_text("é".encode("cp1252"), 'text/html; charset="windows-1252"') == "é" and body_text(b"x", "text/html; charset=nope") == "x"
    assert body_text(None, None) is None and body_text(b"\xff", "application/x") == "\ufffd"


def test_list_files(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    for name, body in (("a b/ሕ+ግ%20.pdf", b"123"), ("x.pdf", b""), ("y.pdf.1.part", b"1")):
        (tmp_path / name).write_bytes(body)
    assert sorted(map(tuple, list_files(spark, str(tmp_path)).collect())) == [("a b/ሕ+ግ%20.pdf", 3)]
    assert list_files(spark, str(tmp_path / "none")).count() == 0


def test_one_document(tmp_path):
    def write(name, body):
        ok, filename, size, error, staged = stage(str(tmp_path), str(tmp_path / "_jobs" / "a"), "s", name, lambda: iter([body]))
        return _move(str(tmp_path), {"seq": 0, "section": "s", "ok": ok, "filename": filename, "file_size_bytes": size, "error": error, "staged": staged})[1:]

    assert write("a.pdf", b"%PDF") == (True, "a.pdf", 4, None)
    assert write("a.pdf", b"other and longer") == (True, "a.pdf", 4, None)
    assert write("h.pdf", b"\n<html>")[:3] == (False, "h.pdf", 0)
    assert write("e.pdf", b"") == (True, "e.pdf", 0, None)
    assert write("e.pdf", b"now") == (True, "e.pdf", 3, None)
    ok, name, size, error = write("x" * 300 + ".pdf", b"a")
    assert (ok, name, size) == (False, "", 0) and error
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == ["a.pdf", "e.pdf"]


def bodies(spark, n=6):
    rows = [(i, f"s{i % 2}", f"{i // 2}.pdf", 404 if i == 5 else 200, bytearray(f"%PDF {i}".encode()), None) for i in range(n)]
    return spark.createDataFrame(rows, "seq long, section string, filename string, status int, body binary, error string")


def test_documents_appear_when_they_are_published(spark, tmp_path):
    root = str(tmp_path)
    job = stage_bodies(bodies(spark), root)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["_jobs"] and [j.job for j in Staged.open(spark, root)] == [job.job]
    assert list_files(spark, root).count() == 0 and job.results.where("ok").count() == 5
    done = job.publish(spark.createDataFrame([(0,), (3,), (5,)], "seq long"))
    assert sorted((r.seq, r.ok) for r in done.collect()) == [(0, True), (3, True), (5, False)]
    assert sorted(map(tuple, list_files(spark, root).collect())) == [("s0/0.pdf", 6), ("s1/1.pdf", 6)]
    assert Staged.open(spark, root) == [] and not list(tmp_path.rglob("files-*"))
    job.forget()
    assert not (tmp_path / "_jobs").exists()


def test_a_publication_that_broke_off_is_taken_up(spark, tmp_path):
    job = stage_bodies(bodies(spark), str(tmp_path))
    first = job.results.where("seq = 0").first().asDict()
    assert _move(str(tmp_path), first)[1] and _move(str(tmp_path), first) == (0, True, "0.pdf", 6, None)
    (again,) = Staged.open(spark, str(tmp_path))
    assert again.publish().where("ok").count() == 5 and list_files(spark, str(tmp_path)).count() == 5


def test_an_aborted_write_leaves_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    broken = bodies(spark).withColumn("body", F.when(F.col("seq") == 4, F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("body")))
    with pytest.raises(Exception, match="lost"):
        stage_bodies(broken, str(tmp_path))
    assert not list(tmp_path.rglob("*.pdf")) and Staged.open(spark, str(tmp_path)) == []


KILLED = """
import os, sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from gleaner.sources.sink import stage_bodies
root = sys.argv[1]
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", root + "/cp").getOrCreate()
rows = spark.createDataFrame([(i, "s", f"{i}.pdf", 200, bytearray(b"%PDF" * 1000), None) for i in range(40)], "seq long, section string, filename string, status int, body binary, error string")
import gleaner.sources.sink as sink
class Dying(sink.DocumentWriter):
    def _results(self, batches, files):
        for i, r in enumerate(super()._results(batches, files)):
            if i == 5 and TaskContext.get().attemptNumber() == 0:
                os._exit(7)
            yield r
class Sink(sink.DocumentSink):
    def writer(self, schema, overwrite):
        return Dying(self.options, False)
sink.DocumentSink = Sink
job = stage_bodies(rows, root + "/out")
assert len([x for x in os.listdir(job.folder) if x.startswith("files-")]) <= 2, os.listdir(job.folder)
done = job.publish().collect()
assert sorted(r.seq for r in done) == list(range(40)) and all(r.ok and r.file_size_bytes == 4000 for r in done)
job.forget()
assert sorted(os.listdir(root + "/out")) == ["s"] and len(os.listdir(root + "/out/s")) == 40
print("GOOD")
"""


def test_a_killed_task_leaves_nothing(tmp_path):
    import os
    import subprocess
    import sys

    from tests.conftest import ROOT

    out = subprocess.run([sys.executable, "-c", KILLED, str(tmp_path)], cwd=ROOT, capture_output=True, text=True, timeout=180, env=os.environ | {"PYTHONPATH": str(ROOT)})
    assert "GOOD" in out.stdout, out.stderr[-3000:]


def test_hosts_take_turns():
    now, order = [0.0], []
    rows = [("a", 1), ("a", 2), ("b", 1), ("a", 3), ("b", 2), ("c", 1)]
    for host, i in in_turn(iter(rows), lambda r: r[0], 1.0, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s)):
        order.append((round(now[0], 6), host, i))
        now[0] += 0.1
    by = {h: [(t, i) for t, x, i in order if x == h] for h in "abc"}
    assert len(order) == 6 and all([i for _, i in v] == sorted(i for _, i in v) for v in by.values())
    assert all(t2 - t1 >= 1.1 - 1e-9 for v in by.values() for (t1, _), (t2, _) in zip(v, v[1:], strict=False))
    assert now[0] < 2.5  # one after another they would take 5 seconds
    assert list(in_turn(iter("xyz"), lambda r: "h", 0)) == ["x", "y", "z"]
    # A host that comes back after its rows have run out keeps its delay.
    times = []
    now[0] = 0.0
    for r in in_turn(iter("ab" * 3), lambda r: r, 1.0, ahead=1, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s)):
        times.append((r, now[0]))
    assert [t for r, t in times if r == "a"] == [0.0, 1.0, 2.0]


def test_hosts_are_dealt_by_weight(spark):
    from pyspark.sql import functions as F

    urls = spark.createDataFrame([(f"http://h{i % 2}/{i}",) for i in range(100)] + [(f"http://small{i}/",) for i in range(20)], "url string")
    got = by_host(urls, parts=4).withColumn("p", F.spark_partition_id()).selectExpr("p", "regexp_extract(url, '//([^/]*)', 1) as host").distinct().collect()
    at = {r.host: r.p for r in got}
    assert len(got) == len(at) == 22 and at["h0"] != at["h1"] and all(at[h] not in (at["h0"], at["h1"]) for h in at if h.startswith("small"))


def test_two_hosts_of_one_task_take_half_the_time(spark, server):
    import time

    base, _ = server
    other = base.replace("127.0.0.1", "localhost")
    urls = spark.createDataFrame([(f"{b}/d/1?{i}",) for i in range(6) for b in (base, other)], "url string").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        HttpFetcher(Policy(delay=0.0, retries=0)).fetch(urls.limit(1)).collect()
        begin = time.monotonic()
        assert len(HttpFetcher(Policy(delay=0.4, retries=0)).fetch(urls).collect()) == 12
        took = time.monotonic() - begin
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert 2.0 <= took < 4.0  # one after another: 11 * 0.4 = 4.4 seconds


def test_files_are_the_recorded_downloads_at_any_limit(spark, server, tmp_path):
    base, hits = server
    listing = '<a href="/none1.pdf">1</a><a href="/none2.pdf">2</a><a href="/direct.pdf">3</a><a href="/last.pdf">4</a><a href="/DocumentDownload.ashx?DocumentId=1">5</a>'
    SITE["/odd"] = (200, "text/html; charset=utf-8", listing.encode())
    for limit, want in ((1, ["direct.pdf"]), (2, ["direct.pdf", "last.pdf"]), (9, ["direct.pdf", "doc_1_ሕግ.pdf", "last.pdf"])):
        catalog = spark.createDataFrame([(0, "sec", "Sec", f"{base}/odd", None, "")], CATALOG)
        at = tmp_path / str(limit)
        c = Crawl(spark, catalog, HttpFetcher(POLICY), Registry(spark, str(at / "registry")), str(at / "out"), str(at / "work"), limit=limit)
        counts = c.run()
        assert counts["pdfs_downloaded"] == len(want) and counts["pdfs_failed"] == 2
        assert sorted(p.name for p in (at / "out" / "sec").iterdir()) == want and not (at / "out" / "_jobs").exists()
        assert sorted(r.filename for r in c.store.load().where("status = 'success'").collect()) == want
        assert [p.name.partition("-")[0] for p in (at / "work").iterdir()] == ["failed"]


def test_stream(spark, tmp_path):
    from gleaner.streaming.registry_stream import follow
    from tests.test_registry_and_runs import event

    source = str(tmp_path / "in")
    store = Registry(spark, str(tmp_path / "r"))
    for rows in ([event(0, "a", "success"), event(1, "b", "failed")], [event(0, "a", "failed"), event(1, "c", "success")]):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(source)
        follow(spark.readStream.schema(EVENT).parquet(source), store, str(tmp_path / "cp")).awaitTermination()
    assert {r.doc_key: r.status for r in store.load().collect()} == {"a": "failed", "b": "failed", "c": "success"}
    # Appended batches and streamed ones share one order, and a batch that comes again counts once.
    store.append(spark.createDataFrame([event(0, "c", "failed")], EVENT))
    store.append_batch(spark.createDataFrame([event(0, "b", "success")], EVENT), 7)
    store.append_batch(spark.createDataFrame([event(0, "b", "success")], EVENT), 7)
    assert {r.doc_key: r.status for r in store.load().collect()} == {"a": "failed", "b": "success", "c": "failed"} and store.recent().count() == 6
    # A snapshot takes in the batches of streams; one that comes again after it is not counted again.
    before = {r.doc_key: r.status for r in store.load().collect()}
    store.compact()
    store.append_batch(spark.createDataFrame([event(0, "b", "failed")], EVENT), 7)
    assert {r.doc_key: r.status for r in store.load().collect()} == before and store.recent().count() == 0


def test_a_streamed_crawl_goes_on_where_it_was(spark, server, tmp_path):
    from gleaner.streaming.crawl_stream import CrawlStream

    base, hits = server
    c = crawl(spark, base, tmp_path)
    whole = sorted(map(str, c.discover().select("seq", "kind", "doc_key", "page_num", "article_title").collect()))
    hits.clear()
    at = str(tmp_path / "work" / "stream")
    assert CrawlStream(c, at, 2).run(batches=1) == 4
    broken = CrawlStream(c, at, 2)

    def lost(rows, number):
        raise RuntimeError("lost")

    broken._add = lost  # after the pages have been kept
    with pytest.raises(Exception, match="lost"):
        broken.run()
    again = CrawlStream(c, at, 3)
    assert again.run() == 0 and again.run() == 0
    assert sorted(map(str, again.log().select("seq", "kind", "doc_key", "page_num", "article_title").collect())) == whole
    assert hits == {"/l": 1, "/l/PageID/2": 1, "/d/1": 1, "/d/2": 1, "/d/404": 1, "/d/3": 1}


def test_articles_of_a_streamed_crawl_widen_nothing(spark, server, tmp_path):
    """A batch of articles alone reads no pages of the batches before and adds no step."""
    import json

    from gleaner.streaming.crawl_stream import CrawlStream

    at = str(tmp_path / "work" / "stream")
    assert CrawlStream(crawl(spark, server[0], tmp_path), at, 1).run() == 0
    with open(f"{at}/frontier/_steps") as f:
        steps = json.load(f)
    assert steps["rows"] == 6 and all(s["last"] > s["after"] for s in steps["steps"]) and len(steps["steps"]) == 3


def test_of_an_ordered_table_only_the_range_of_the_urls_is_read(spark, tmp_path):
    at = str(tmp_path / "site")
    rows = spark.range(100).selectExpr("concat('u', 100 + id) url", "200 status", "map('a', 'b') headers", "cast(cast(id as string) as binary) body", "cast(null as string) error")
    rows.repartitionByRange(4, "url").sortWithinPartitions("url").write.parquet(at)
    urls = spark.createDataFrame([("u150",), ("u120",), ("u1555",), ("u120",)], "url string")
    got = TableFetcher(spark.read.parquet(at), ordered=True).fetch(urls)
    assert sorted((r.url, r.status) for r in got.collect()) == [("u120", 200), ("u150", 200), ("u1555", 404)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(url,u120), LessThanOrEqual(url,u1555)" in plan
    assert TableFetcher(spark.read.parquet(at), ordered=True).fetch(urls.limit(0)).count() == 0


def test_cli(spark, server, tmp_path, capsys):
    import json

    base, _ = server
    (tmp_path / "c.json").write_text(json.dumps([{"section_key": "sec", "name": "Sec", "start_url": f"{base}/l", "description": "d"}]))
    assert cli.main([str(tmp_path / "c.json"), "--list-sections"], spark) == 0
    assert "sec" in capsys.readouterr().out
    assert cli.main([str(tmp_path / "c.json"), "--delay", "0", "--output-dir", str(tmp_path / "o"), "--section", "all", "--limit", "1"], spark) == 0
    assert "|pdfs downloaded      |1     |" in capsys.readouterr().out
    assert cli.main([str(tmp_path / "c.json"), "--section", "zz"], spark) == 1


def test_shapes(spark):
    assert spark.createDataFrame([], RESPONSE).columns == ["url", "status", "headers", "body", "error"]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from gleaner.session import local_path, shared_dir

    def session(master, at=None):
        conf = SimpleNamespace(get=lambda key, other=None: at or other)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))

    assert shared_dir(session("spark://host:7077", "hdfs:///check/")) == "hdfs:///check" and shared_dir(session("local[4]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))
    assert local_path("file:///a/b") == "/a/b" == local_path("file:/a/b") == local_path("/a/b")
