"""A crawl: discover, plan, fetch, record, count.  Functions from tables to tables; effects only in fetchers and the registry."""

from __future__ import annotations

import logging
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.filenames import derive_filename
from ..functions.url import doc_key
from ..operators import extract, listing, outcome, registry
from ..operators.dedupe import keep_first
from ..schemas import DOWNLOAD
from ..session import local_path, ship
from ..sources.fetch import Fetcher
from ..sources.files import delete, list_files
from ..sources.live import counted, watched
from ..sources.sink import JOBS, Staged, stage_bodies

_log = logging.getLogger(__name__)
PLACE = ("section_ord", "section_key", "page_num")


def bad() -> Column:
    return F.col("error").isNotNull() | F.col("status").isNull() | (F.col("status") >= 400)


def fault() -> Column:
    return F.coalesce("error", F.concat(F.lit("HTTP "), F.col("status").cast("string")))


@dataclass
class Crawl:
    """A crawl of a catalog with a fetcher, into a registry and a folder.

    work is a folder that driver and executors share: what is learned from responses
    is written there once, before several plans read it.  With fail_fast a section whose
    first page fails ends the run; else it is left out and reported by ``failed_pages``.

    Without a limit each step is one job over all sections.  With one, the crawl is a
    frontier that is widened only as long as downloads are wanted: the first page of a
    section and its articles a few at a time, then twice as many pages at each step.

    Progress: each step that is written appends its observed counts to ``progress``,
    logs them and, if on_progress is given, passes them on.  While a step runs, its counts so
    far are logged and passed on, marked as ``running``, each ``every`` seconds, by a thread:
    its tasks and, of downloads, also rows, ok and bytes.
    """

    spark: SparkSession
    catalog: DataFrame
    fetcher: Fetcher
    store: registry.Registry
    output: str
    work: str
    limit: int | None = None
    max_pages: int | None = None
    dry_run: bool = False
    fail_fast: bool = True
    dedupe_articles: bool = False
    strict: bool = False
    on_progress: Callable[[dict], None] | None = None
    every: float = 5.0
    progress: list[dict] = field(default_factory=list)

    def __post_init__(self):
        ship(self.spark)
        self._kept: list[str] = []
        self._start()

    def _start(self) -> None:
        self.failed_pages = self.spark.createDataFrame([], "section_key string, page_url string, error string")
        self._articles_before: list[DataFrame] = []

    def _keep(self, df: DataFrame, step: str = "", **counts: Column) -> DataFrame:
        path = f"{self.work.rstrip('/')}/{uuid.uuid4().hex}"
        seen = Observation()
        if step:
            df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in counts.items()))
        self._kept.append(path)
        with self._watched(step) if step else nullcontext():
            df.write.parquet(path)
        if step:
            self._told({"step": step, **seen.get})
        return self.spark.read.schema(df.schema).parquet(path)

    def _watched(self, step: str, counts: Callable[[], dict] = dict) -> AbstractContextManager[None]:
        return watched(self.spark, lambda now: self._tell({"step": step, "running": True, **now}), self.every, counts)

    def _told(self, counts: dict) -> None:
        self.progress.append(counts)
        self._tell(counts)

    def _tell(self, counts: dict) -> None:
        _log.info("%s", counts)
        if self.on_progress:
            self.on_progress(counts)

    # ---------------------------------------------------------------- discovery

    def _read(self, urls: DataFrame, want: tuple[str, ...], step: str) -> DataFrame:
        """url, status, error and parsed of each distinct URL; a response is parsed where it is fetched."""
        answers = self.fetcher.fetch(urls).withColumn("body", F.when(~bad(), F.col("body")))
        return self._keep(extract.parse_pages(answers, "body", "url", ("status", "error"), want, "headers"), step, failed=F.count_if(bad()))

    def _first_pages(self, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The plan of all listing pages of some sections, and their first pages as _read gives them."""
        first = self._read(sections.select(F.col("start_url").alias("url")), ("pager", "articles", "documents"), "first pages")
        firsts = sections.join(first, F.col("start_url") == F.col("url"))
        lost = firsts.where(bad()).select("section_key", F.col("start_url").alias("page_url"), fault().alias("error"))
        if self.fail_fast and (row := lost.first()):
            raise RuntimeError(f"first page of section {row.section_key} failed: {row.error}")
        self.failed_pages = self.failed_pages.unionByName(lost)
        alive = sections.join(lost.select("section_key"), "section_key", "left_anti")
        return self._keep(listing.plan_listing(alive, extract.pager_info(firsts.where(~bad()), ("section_key",)), self.max_pages)), first

    def _listed(self, plan: DataFrame, first: DataFrame) -> DataFrame:
        """The pages of a plan with their parsed links; first has those that have been fetched already."""
        parsed = F.struct("parsed.articles", "parsed.documents").alias("parsed")
        known = first.select("url", "status", "error", parsed)
        missing = plan.select(F.col("page_url").alias("url")).join(known.select("url"), "url", "left_anti")
        rest = self._read(missing, ("articles", "documents"), "listing pages").select("url", "status", "error", parsed)
        pages = plan.join(known.unionByName(rest), F.col("page_url") == F.col("url"))
        # First pages that failed have been reported.
        self.failed_pages = self.failed_pages.unionByName(pages.where(bad()).select("section_key", "page_url", fault().alias("error")))
        return pages.where(~bad()).select(*PLACE, "page_url", "parsed")

    def _articles(self, listed: DataFrame) -> DataFrame:
        arts = extract.article_links(listed, (*PLACE, "page_url"))
        if self.dedupe_articles:
            arts = keep_first(arts, ["url"], ["section_ord", "page_num", "pos"])
            for before in self._articles_before:
                arts = arts.join(before.select("url"), "url", "left_anti")
        arts = self._keep(arts, "articles")
        self._articles_before.append(arts)
        return arts

    @staticmethod
    def page_rows(listed: DataFrame) -> DataFrame:
        """Rows of pages and of the documents that they link themselves."""
        direct = extract.document_links(listed, PLACE).withColumnRenamed("pos", "doc_pos")
        here = {"is_article": F.lit(0), "art_pos": F.lit(-1)}
        return (
            listed.select(*PLACE).withColumns({**here, "doc_pos": F.lit(-1), "kind": F.lit("page")})
            .unionByName(direct.withColumns({**here, "kind": F.lit("document")}), allowMissingColumns=True)
        )

    def _article_rows(self, arts: DataFrame) -> DataFrame:
        bodies = self._read(arts.select("url"), ("documents",), "article pages")
        gone = bodies.where(bad()).join(arts.select("section_key", "url"), "url")
        self.failed_pages = self.failed_pages.unionByName(gone.select("section_key", F.col("url").alias("page_url"), fault().alias("error")))
        return self.article_rows(arts, bodies)

    @staticmethod
    def article_rows(arts: DataFrame, bodies: DataFrame) -> DataFrame:
        """Rows of articles, also of those that fail or hold nothing, and of their documents."""
        place = [*PLACE, F.col("pos").alias("art_pos")]
        visited = arts.select(*place).withColumns({"is_article": F.lit(1), "doc_pos": F.lit(-1), "kind": F.lit("article")})
        met = arts.select(*place, "url", F.col("title").alias("listing_title")).join(bodies.where(~bad()).select("url", "parsed.documents"), "url")
        each = met.select(*PLACE, "art_pos", "listing_title", F.explode("documents").alias("d")).select(*PLACE, "art_pos", "listing_title", "d.*")
        docs = each.withColumn("article_title", extract.carried_title(F.col("article_title"), F.col("listing_title"))).drop("listing_title").withColumnRenamed("pos", "doc_pos")
        return visited.unionByName(docs.withColumns({"is_article": F.lit(1), "kind": F.lit("document")}), allowMissingColumns=True)

    def numbered(self, rows: DataFrame, base: int = 0) -> DataFrame:
        """A log of rows in the order of the crawl, seq from base + 1 on."""
        blank = self.spark.createDataFrame([], "article_title string, article_url string, download_url string, link_text string, document_id string, article_id string, module_id string")
        keyed = rows.unionByName(blank, allowMissingColumns=True).withColumn("doc_key", F.when(F.col("kind") == "document", doc_key(F.col("document_id"), F.col("download_url"))))
        log = outcome.numbered(keyed.withColumnRenamed("section_key", "section"), ["section_ord", "page_num"], ["is_article", "art_pos", "doc_pos"])
        return self._keep(log.withColumn("seq", F.col("seq") + base), "log", documents=F.count_if(F.col("kind") == "document"))

    def discover(self, section: str = "all") -> DataFrame:
        """A log of the whole crawl in order: a row for each page, article and document.

        Columns: seq, kind, section_ord, section, page_num, and what is known of a document.
        """
        self._start()
        listed = self._listed(*self._first_pages(listing.select_sections(self.catalog, section)))
        return self.numbered(self.page_rows(listed).unionByName(self._article_rows(self._articles(listed)), allowMissingColumns=True))

    def frontier(self, section: str = "all") -> Iterator[DataFrame]:
        """The same log in parts, in order, each of which is fetched only when it is asked for.

        Of a section's first page: the page and its own documents, then its articles, one, two,
        four and so on at a time.  Then two, four and so on pages at a time.
        """
        self._start()
        base = 0
        sections = listing.select_sections(self.catalog, section)
        for s in sections.select("section_key").orderBy("section_ord").collect():  # a catalog is small by nature
            plan, first = self._first_pages(sections.where(F.col("section_key") == s.section_key))
            total, at, size = plan.count(), 0, 1
            while at < total:
                listed = self._listed(plan.where((F.col("page_num") > at) & (F.col("page_num") <= at + size)), first)
                if size == 1:
                    yield (part := self.numbered(self.page_rows(listed), base))
                    base += part.count()
                    arts = self._articles(listed)
                    count, done, step = arts.count(), 0, 1
                    while done < count:
                        some = arts.orderBy("pos").offset(done).limit(step)
                        yield (part := self.numbered(self._article_rows(self._keep(some)), base))
                        base, done, step = base + part.count(), done + step, 2 * step
                else:
                    yield (part := self.numbered(self.page_rows(listed).unionByName(self._article_rows(self._articles(listed)), allowMissingColumns=True), base))
                    base += part.count()
                at, size = at + size, 2 * size

    # ---------------------------------------------------------------- the run

    def _known(self, log: DataFrame, files: DataFrame) -> DataFrame:
        skipped, _ = self.store.split(log.where("kind = 'document'"), files)
        return log.join(skipped.select("seq", F.lit(True).alias("known")), "seq", "left")

    def run(self, section: str = "all", files: DataFrame | None = None) -> dict[str, int]:
        """The six counters.  files (path, length) are those below the output folder, which is listed if none are given.

        What a part of the crawl did is recorded before the next one begins.  The files that it
        leaves are those of its recorded downloads, with any limit: what has been
        downloaded beyond the limit, or twice, never gets its name.
        """
        listing.select_sections(self.catalog, section)  # an unknown one is an error before anything is written
        try:
            return self._run(section, files)
        finally:
            self._clean()

    def _run(self, section: str, files: DataFrame | None) -> dict[str, int]:
        for left in Staged.open(self.spark, local_path(self.output)):  # of a run that was broken off before it recorded them
            left.forget()
        if files is None:
            files = list_files(self.spark, self.output)
        if self.dry_run:
            log = self._known(self.discover(section), files).withColumns({"ok": F.lit(False), "size": F.lit(0).cast("long")})
            return outcome.counters(outcome.resolve_run(log, self.limit, True)).first().asDict()
        counts = dict.fromkeys(outcome.COUNTERS, 0)
        if self.limit and self.limit < 0:
            return counts
        files = self._keep(files)
        settled: list[DataFrame] = []
        for part in self.frontier(section) if self.limit else [self.discover(section)]:
            left = self.limit - counts["pdfs_downloaded"] if self.limit else None
            log = self._known(part, files)
            if settled:  # keys that an earlier part has downloaded
                log = log.join(self._all(settled).distinct().withColumn("_settled", F.lit(True)), "doc_key", "left").withColumn("known", F.coalesce("known", "_settled")).drop("_settled")
            resolved = self._fetch(self._keep(log), left)
            docs = resolved.where("kind = 'document'")
            settled.append(self._keep(docs.where("ok and size > 0").select("doc_key")))
            self.store.append(registry.success_events(docs.where("action = 'downloaded'")).unionByName(registry.failure_events(docs.where("action = 'failed'"))))
            for name, n in outcome.counters(resolved).first().asDict().items():
                counts[name] += n
            if self.limit and counts["pdfs_downloaded"] >= self.limit:
                break
        return counts

    def _fetch(self, log: DataFrame, wanted: int | None) -> DataFrame:
        """The rows of a part's log that the run comes to, resolved, with the results of their downloads.

        With a limit documents are taken in order, as many at a time as are still wanted,
        and more where none went well.  Of the rows of one key only the first is asked for;
        the others are where it failed.  All are staged first, and only those that
        the run counts as downloaded are published.
        """
        todo = self._keep(log.where("kind = 'document' and known is null"))
        staged: list[Staged] = []
        if wanted is None:
            staged += self._round(todo)
        else:
            at, got, step = 0, 0, wanted
            while got < wanted:
                last = todo.where(F.col("seq") > at).orderBy("seq").limit(step).agg(F.max("seq").alias("last")).first().last
                if last is None:
                    break
                now = todo.where((F.col("seq") > at) & (F.col("seq") <= last))
                for s in staged:
                    now = now.join(todo.join(s.results.where("ok and file_size_bytes > 0").select("seq"), "seq", "left_semi").select("doc_key"), "doc_key", "left_anti")
                new = self._round(self._keep(now))
                staged += new
                more = sum(s.results.where("ok").count() for s in new)
                at, got, step = last, got + more, max(1, wanted - got - more) if more else 2 * step
        if not staged:
            return self._keep(outcome.resolve_run(self._with(log, self.spark.createDataFrame([], DOWNLOAD)), wanted))
        results = self._all([s.results.select("seq", "ok", "filename", "file_size_bytes", "error") for s in staged])
        counted = self._keep(outcome.resolve_run(self._with(log, results), wanted).where("action = 'downloaded'").select("seq"))
        published = self._all([s.publish(counted) for s in staged])
        # A file that could not be given its name has failed.
        final = results.join(published.select("seq"), "seq", "left_anti").unionByName(published)
        resolved = self._keep(outcome.resolve_run(self._with(log, final), wanted))
        for s in staged:
            s.forget()
        return resolved

    @staticmethod
    def _with(log: DataFrame, results: DataFrame) -> DataFrame:
        return log.join(results.select("seq", "ok", F.col("file_size_bytes").alias("size"), "filename", "file_size_bytes", "error"), "seq", "left")

    def _round(self, docs: DataFrame) -> list[Staged]:
        """The first row of each key, staged, and the other rows of the keys that it did not settle."""
        first = docs.groupBy("doc_key").agg(F.min("seq").alias("seq")).select("seq")
        done = self._stage(docs.join(first, "seq", "left_semi"), "downloads")
        settled = docs.join(done.results.where("ok and file_size_bytes > 0").select("seq"), "seq", "left_semi").select("doc_key").distinct()
        more = self._keep(docs.join(done.results.select("seq"), "seq", "left_anti").join(settled, "doc_key", "left_anti"))
        return [done] if more.isEmpty() else [done, self._stage(more, "further downloads")]

    @staticmethod
    def _all(parts: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, parts)

    def _stage(self, docs: DataFrame, step: str) -> Staged:
        name = lambda header: derive_filename(F.col("document_id"), F.col("download_url"), F.col("link_text"), F.col("article_title"), header, self.strict)
        with self._watched(step, lambda: counted(os.path.join(local_path(self.output), JOBS))):
            if hasattr(self.fetcher, "stage"):
                named = docs.select("seq", "section", F.col("download_url").alias("url"), "document_id", name(F.lit(None).cast("string")).alias("fallback"))
                out = self.fetcher.stage(named, self.output, self.strict)
            else:
                answers = self.fetcher.fetch(docs.select(F.col("download_url").alias("url")))
                header = F.coalesce(F.try_element_at("headers", F.lit("content-disposition")), F.try_element_at("headers", F.lit("Content-Disposition")))
                out = stage_bodies(docs.join(answers, docs["download_url"] == answers["url"]).select("seq", "section", name(header).alias("filename"), "status", "body", "error"), self.output)
        counts = out.results.agg(F.count("*").alias("rows"), F.count_if("ok").alias("ok"), F.sum("file_size_bytes").alias("bytes")).first()
        self._told({"step": step, **counts.asDict()})
        return out

    def _clean(self) -> None:
        """Deletes what the run has kept on the way; the table of failed pages stays."""
        if self._kept:
            path = f"{self.work.rstrip('/')}/failed-{uuid.uuid4().hex}"
            shape = self.failed_pages.schema
            self.failed_pages.write.parquet(path)
            self.failed_pages = self.spark.read.schema(shape).parquet(path)
        for kept in self._kept:
            delete(self.spark, kept)
        self._kept = []
