"""A crawl as a stream: its frontier is a source with offsets, each micro-batch asks for a bounded number of URLs and adds what they link to.

The frontier is a folder of steps, tables of URLs that are numbered in the order in which
they were found.  ``gleaner_frontier`` reads it as a stream; its offset is a number, and a
batch ends ``per_batch`` URLs after the last one that has been dealt with.  A batch
keeps its pages, parsed, before it adds a step, and both before the frontier moves on; each
of these is one table or file that appears at once.  A crawl that is stopped or killed
anywhere goes on where it was, from the checkpoint, and asks for no URL whose page it has.

The work folder has to be mounted where the driver and the tasks run.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..operators import extract, listing, outcome
from ..operators.dedupe import keep_first
from ..plans.crawl import PLACE, Crawl, bad, fault
from ..session import local_path, ship

FRONTIER = "at long, kind string, section_ord int, section_key string, page_num int, pos int, url string, title string, page_url string"
PARSED = ("pager", "articles", "documents")


def _get(path: str) -> dict | None:
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except FileNotFoundError:
        return None


def _put(path: str, value: dict) -> None:
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "w", encoding="utf-8") as f:
        json.dump(value, f)
    os.replace(part, path)


@dataclass
class Slice(InputPartition):
    file: str
    after: int
    last: int


class Frontier(DataSource):
    """Options: path, per_batch."""

    @classmethod
    def name(cls) -> str:
        return "gleaner_frontier"

    def schema(self) -> str:
        return FRONTIER

    def streamReader(self, schema) -> FrontierReader:
        return FrontierReader(self.options["path"], int(self.options.get("per_batch", 10_000)))


class FrontierReader(DataSourceStreamReader):
    def __init__(self, path: str, per_batch: int):
        self.path, self.per_batch = path, per_batch

    def initialOffset(self) -> dict:
        return {"at": 0}

    def latestOffset(self) -> dict:
        done = (_get(f"{self.path}/_done") or {"at": 0})["at"]
        return {"at": min(done + self.per_batch, _get(f"{self.path}/_steps")["rows"])}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        out = []
        for step in _get(f"{self.path}/_steps")["steps"]:
            if step["after"] < end["at"] and step["last"] > start["at"]:
                folder = f"{self.path}/{step['folder']}"
                out += [Slice(f"{folder}/{f}", start["at"], end["at"]) for f in sorted(os.listdir(folder)) if f.endswith(".parquet")]
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        rows = ds.dataset(partition.file)
        inside = (ds.field("at") > partition.after) & (ds.field("at") <= partition.last)
        yield from rows.to_batches(columns=[c.split()[0] for c in FRONTIER.split(", ")], filter=inside)


class CrawlStream:
    """A crawl (of which catalog, fetcher, max_pages and fail_fast are used) whose frontier and pages are in a folder of its own."""

    def __init__(self, crawl: Crawl, folder: str, per_batch: int = 10_000):
        self.crawl, self.spark, self.folder, self.per_batch = crawl, crawl.spark, local_path(folder.rstrip("/")), per_batch
        ship(self.spark)
        self.spark.dataSource.register(Frontier)

    def _table(self, name: str) -> str:
        return f"file://{self.folder}/{name}"

    def _whole(self, name: str) -> bool:
        return os.path.exists(f"{self.folder}/{name}/_SUCCESS")

    def _read(self, kind: str, last: int | None = None) -> DataFrame | None:
        """The tables of a kind of all batches, or of those up to one."""
        at = f"{self.folder}/{kind}"
        found = [f for f in (os.listdir(at) if os.path.isdir(at) else []) if self._whole(f"{kind}/{f}") and (last is None or int(f) <= last)]
        return self.spark.read.parquet(*(self._table(f"{kind}/{f}") for f in sorted(found, key=int))) if found else None

    # ------------------------------------------------------------ the frontier

    def _add(self, rows: DataFrame, number: int) -> None:
        """Adds a step, once: rows are numbered after those that are there."""
        known = _get(f"{self.folder}/frontier/_steps") or {"rows": 0, "steps": []}
        if any(s["number"] == number for s in known["steps"]):
            return
        folder = f"step-{number}-{uuid.uuid4().hex[:8]}"
        shape = [c.split()[0] for c in FRONTIER.split(", ")]
        placed = outcome.numbered(rows, ["section_ord", "page_num"], ["pos"], "at").withColumn("at", F.col("at") + known["rows"]).select(*shape).to(self.spark.createDataFrame([], FRONTIER).schema)
        placed.write.parquet(self._table(f"frontier/{folder}"))
        last = self.spark.read.parquet(self._table(f"frontier/{folder}")).agg(F.coalesce(F.max("at"), F.lit(known["rows"]))).first()[0]
        step = {"number": number, "folder": folder, "after": known["rows"], "last": last}
        _put(f"{self.folder}/frontier/_steps", {"rows": last, "steps": [*known["steps"], step]})

    def _begin(self, section: str) -> None:
        if _get(f"{self.folder}/frontier/_steps") is None:
            os.makedirs(f"{self.folder}/frontier", exist_ok=True)
            first = listing.select_sections(self.crawl.catalog, section)
            none = F.lit(None).cast("string")
            self._add(first.select(F.lit("first").alias("kind"), "section_ord", "section_key", F.lit(1).alias("page_num"), F.lit(-1).alias("pos"), F.col("start_url").alias("url"), none.alias("title"), none.alias("page_url")), -1)

    def _batch(self, batch: DataFrame, number: int) -> None:
        """Asks for the pages of a batch of the frontier, adds what they link to, and moves on; each part that is there already stays."""
        if not self._whole(f"rows/{number}"):
            batch.write.mode("overwrite").parquet(self._table(f"rows/{number}"))
        rows = self.spark.read.schema(FRONTIER).parquet(self._table(f"rows/{number}"))
        if not self._whole(f"pages/{number}"):
            urls = rows.select("url").distinct()
            if (before := self._read("pages", number - 1)) is not None:
                # Of the pages that are there those that are asked for again: few, so that no exchange has all.
                urls = urls.join(before.select("url").join(urls, "url", "left_semi"), "url", "left_anti")
            answers = self.crawl.fetcher.fetch(urls).withColumn("body", F.when(~bad(), F.col("body")))
            extract.parse_pages(answers, "body", "url", ("status", "error"), PARSED, "headers").write.mode("overwrite").parquet(self._table(f"pages/{number}"))
        if not rows.where("kind <> 'article'").isEmpty():  # articles link to nothing that is asked for
            self._widen(rows, number)
        last = rows.agg(F.max("at").alias("at")).first().at
        if last is not None:
            _put(f"{self.folder}/frontier/_done", {"at": last})

    def _widen(self, rows: DataFrame, number: int) -> None:
        """Adds what the first pages and the listings of a batch link to."""
        pages = self._read("pages", number).select("url", "status", "error", "parsed")
        met = rows.where("kind <> 'article'").join(pages, "url")
        firsts = met.where("kind = 'first'")
        if self.crawl.fail_fast and (lost := firsts.where(bad()).select("section_key", fault().alias("error")).first()):
            raise RuntimeError(f"first page of section {lost.section_key} failed: {lost.error}")
        good = firsts.where(~bad())
        sections = self.crawl.catalog.join(good.select("section_key"), "section_key", "left_semi")
        plan = listing.plan_listing(sections, extract.pager_info(good.withColumn("page_url", F.col("url")), ("section_key",)), self.crawl.max_pages)
        more = plan.where("page_num > 1").select(F.lit("listing").alias("kind"), *PLACE, F.lit(-1).alias("pos"), F.col("page_url").alias("url"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("page_url"))
        self._add(more.unionByName(self._linked(met).select(F.lit("article").alias("kind"), *PLACE, "pos", "url", "title", "page_url")), number)

    @staticmethod
    def _listed(met: DataFrame) -> DataFrame:
        return met.where(~bad()).select(*PLACE, F.col("url").alias("page_url"), "parsed")

    def _linked(self, met: DataFrame) -> DataFrame:
        return extract.article_links(self._listed(met), (*PLACE, "page_url"))

    # ------------------------------------------------------------ the run

    def run(self, section: str = "all", batches: int | None = None) -> int:
        """Goes on with the crawl until its frontier is done with, or for so many batches; the number of URLs that are left."""
        self._begin(section)
        path = f"{self.folder}/frontier"
        while (left := _get(f"{path}/_steps")["rows"] - (_get(f"{path}/_done") or {"at": 0})["at"]) and batches != 0:
            source = self.spark.readStream.format("gleaner_frontier").options(path=path, per_batch=str(self.per_batch)).load()
            # A trigger takes what its offsets held when it began: one batch.
            source.writeStream.foreachBatch(self._batch).option("checkpointLocation", self._table("checkpoint")).trigger(availableNow=True).start().awaitTermination()
            batches = None if batches is None else batches - 1
        return left

    def log(self) -> DataFrame:
        """The log of what has been crawled, as ``Crawl.discover`` gives it."""
        rows, pages = self._read("rows"), self._read("pages").select("url", "status", "error", "parsed")
        listed = self._listed(rows.where("kind <> 'article'").join(pages, "url"))
        arts = rows.where("kind = 'article'").select(*PLACE, "pos", "url", "title")
        if self.crawl.dedupe_articles:
            arts = keep_first(arts, ["url"], ["section_ord", "page_num", "pos"])
        return self.crawl.numbered(self.crawl.page_rows(listed).unionByName(self.crawl.article_rows(arts, pages), allowMissingColumns=True))
