"""A sink for documents with a commit protocol: ``gleaner_documents``, a data source that is written to.

1.  *Stage.*  A task writes its documents to a folder of its own attempt below
    ``_jobs/JOB`` of the output folder, and their results to a manifest.  Its commit
    message names the attempt; nothing else passes through the driver.
2.  *Commit.*  The attempts that Spark has accepted are listed in a file that appears
    at once; what other attempts (failed, killed, speculative) have left goes.  An aborted
    job leaves nothing.
3.  *Publish.*  Tasks move the staged files to their names, in the order of seq for
    one name, and give the results.  Each step can be repeated, so a publication that
    breaks off is taken up again (``Staged.open``).  Only some rows may be published; the
    others are rolled back, so a run can download more than it turns out to need.

A document that is there and not empty stays and counts, and its body is not read; of
several rows of one name the first one with a body counts.  HTML fails, an empty body makes an
empty file.  The output folder has to be mounted where the tasks run.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions.filenames import header_filename
from ..functions.rules import HTML_ERROR
from ..schemas import DOWNLOAD
from ..session import local_path, ship
from .live import LIVE, Ticker

JOBS = "_jobs"
STAGED = "seq long, section string, ok boolean, filename string, file_size_bytes long, error string, staged string"
_KIND = pa.schema([("seq", pa.int64()), ("section", pa.string()), ("ok", pa.bool_()), ("filename", pa.string()), ("file_size_bytes", pa.int64()), ("error", pa.string()), ("staged", pa.string())])
#: Results of a manifest's row group.
GROUP = 1024


def size_of(path: str) -> int:
    """Bytes of a file, 0 if it is not there."""
    try:
        return os.path.getsize(path)
    except OSError:
        return 0


def stage(root: str, folder: str, section: str, name: str, body: Callable[[], Iterator[bytes]]) -> tuple[bool, str, int, str | None, str | None]:
    """Stages one document in folder: (ok, filename, size, error, path of the staged file)."""
    staged = os.path.join(folder, section, name)
    try:
        if size := size_of(os.path.join(root, section, name)):
            return True, name, size, None, None
        if size := size_of(staged):  # of an earlier row; whichever is published first gives it its name
            return True, name, size, None, staged
        os.makedirs(os.path.dirname(staged), exist_ok=True)
        size = 0
        with open(staged, "wb") as f:
            for piece in body():
                if not size and piece.lstrip().startswith((b"<!DOCTYPE", b"<html")):
                    os.remove(staged)
                    return False, name, 0, HTML_ERROR, None
                f.write(piece)
                size += len(piece)
        if not size:
            os.remove(staged)
        return True, name, size, None, staged if size else None
    except Exception as e:  # a fault of one file is data
        if os.path.exists(staged):
            os.remove(staged)
        return False, "", 0, str(e), None


@dataclass
class Attempt(WriterCommitMessage):
    name: str
    rows: int


class DocumentSink(DataSource):
    """Rows with url, document_id and fallback are downloaded (option policy); rows with filename, status, body and error are written."""

    @classmethod
    def name(cls) -> str:
        return "gleaner_documents"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options, "url" in schema.names)


class DocumentWriter(DataSourceArrowWriter):
    def __init__(self, options, download: bool):
        self.root, self.job, self.download = options["path"], options["job"], download
        self.strict, self.policy = options.get("strict") == "true", options.get("policy")

    @property
    def folder(self) -> str:
        return os.path.join(self.root, JOBS, self.job)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        name = uuid.uuid4().hex
        files, manifest = os.path.join(self.folder, f"files-{name}"), os.path.join(self.folder, "staged", f"{name}.parquet")
        rows: list[tuple] = []
        done = Ticker(self.folder, TaskContext.get().partitionId())
        try:
            os.makedirs(os.path.dirname(manifest), exist_ok=True)
            with pq.ParquetWriter(manifest, _KIND) as out:
                for row in self._results(iterator, files):
                    rows.append(row)
                    done.add(row[2], row[4])
                    if len(rows) == GROUP:
                        out.write_batch(_batch(rows))
                        rows = []
                if rows:
                    out.write_batch(_batch(rows))
        except BaseException:
            shutil.rmtree(files, ignore_errors=True)
            if os.path.exists(manifest):
                os.remove(manifest)
            raise
        if done.rows:
            done.say()
        return Attempt(name, done.rows)

    def _results(self, batches: Iterator[pa.RecordBatch], files: str) -> Iterator[tuple]:
        rows = (r for b in batches for r in b.to_pylist())
        if self.download:
            yield from self._downloaded(rows, files)
            return
        from .fetch import CHUNK

        for r in rows:
            if r["error"] is not None or r["status"] is None or r["status"] >= 400:
                yield r["seq"], r["section"], False, "", 0, r["error"] or f"HTTP {r['status']}", None
            else:
                whole = r["body"] or b""
                yield r["seq"], r["section"], *stage(self.root, files, r["section"], r["filename"], lambda b=whole: (b[i : i + CHUNK] for i in range(0, len(b), CHUNK)))

    def _downloaded(self, rows: Iterator[dict], files: str) -> Iterator[tuple]:
        from .fetch import Policy, _opener, chunks, exchange
        from .turns import in_turn
        from urllib.parse import urlsplit

        policy = Policy(**json.loads(self.policy))
        opener = _opener(policy)
        for r in in_turn(rows, lambda r: urlsplit(r["url"]).netloc, policy.delay):

            def save(status, headers, answer, error, r=r):
                if error is not None or status is None or status >= 400:
                    return False, "", 0, error or f"HTTP {status}", None
                name = header_filename(headers.get("content-disposition"), r["document_id"], r["url"], self.strict) or r["fallback"]
                return stage(self.root, files, r["section"], name, lambda: chunks(answer, headers.get("content-encoding")))

            yield r["seq"], r["section"], *exchange(r["url"], policy, save, opener)

    def commit(self, messages: list[Attempt | None]) -> None:
        names = {m.name for m in messages if m is not None}
        shutil.rmtree(os.path.join(self.folder, LIVE), ignore_errors=True)
        os.makedirs(os.path.join(self.folder, "staged"), exist_ok=True)
        for left in os.listdir(self.folder):
            if left.startswith("files-") and left[6:] not in names:
                shutil.rmtree(os.path.join(self.folder, left), ignore_errors=True)
        for left in os.listdir(os.path.join(self.folder, "staged")):
            if left.partition(".")[0] not in names:
                os.remove(os.path.join(self.folder, "staged", left))
        done = os.path.join(self.folder, "committed")
        with open(f"{done}.part", "w", encoding="utf-8") as f:
            json.dump({"attempts": sorted(names), "rows": sum(m.rows for m in messages if m is not None)}, f)
        os.replace(f"{done}.part", done)

    def abort(self, messages: list[Attempt | None]) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KIND.types, strict=True)], schema=_KIND)


@dataclass
class Staged:
    """Documents that are staged and committed, but not yet published."""

    spark: SparkSession
    root: str
    job: str

    @property
    def folder(self) -> str:
        return os.path.join(self.root, JOBS, self.job)

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> list[Staged]:
        """The committed jobs below root whose publication has not been ended."""
        at = os.path.join(root, JOBS)
        return [cls(spark, root, j) for j in sorted(os.listdir(at)) if os.path.exists(os.path.join(at, j, "committed"))] if os.path.isdir(at) else []

    @property
    def results(self) -> DataFrame:
        """A row (STAGED) for each row that was written."""
        return self.spark.read.schema(STAGED).parquet(f"file://{self.folder}/staged")

    def publish(self, wanted: DataFrame | None = None) -> DataFrame:
        """Results (DOWNLOAD) of the rows whose seq is in ``wanted`` (all, if not given), whose files have their names afterwards; other rows are rolled back."""
        root = self.root

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [_move(root, r) for r in batch.to_pylist()]
                kinds = (pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.string())
                if out:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["seq", "ok", "filename", "file_size_bytes", "error"])

        chosen = self.results if wanted is None else self.results.join(wanted.select("seq"), "seq", "left_semi").select(*self.results.columns)
        ordered = chosen.repartition("section", "filename").sortWithinPartitions("section", "filename", "seq")
        ordered.mapInArrow(run, DOWNLOAD).write.mode("overwrite").parquet(f"file://{self.folder}/published")
        for left in os.listdir(self.folder):
            if left.startswith("files-"):
                shutil.rmtree(os.path.join(self.folder, left), ignore_errors=True)
        if os.path.exists(done := os.path.join(self.folder, "committed")):
            os.remove(done)
        return self.spark.read.schema(DOWNLOAD).parquet(f"file://{self.folder}/published")

    def forget(self) -> None:
        """Deletes what is left of the job: its results."""
        shutil.rmtree(self.folder, ignore_errors=True)
        try:
            os.rmdir(os.path.dirname(self.folder))
        except OSError:  # other jobs are at work
            pass


def _move(root: str, r: dict) -> tuple:
    """Gives a staged document its name; once more does no harm."""
    if not r["ok"]:
        return r["seq"], False, r["filename"], 0, r["error"]
    target = os.path.join(root, r["section"], r["filename"])
    try:
        if not size_of(target):
            os.makedirs(os.path.dirname(target), exist_ok=True)
            if r["staged"] and os.path.exists(r["staged"]):
                os.replace(r["staged"], target)
            elif not os.path.exists(target) and not r["file_size_bytes"]:
                open(target, "ab").close()
        return r["seq"], True, r["filename"], os.path.getsize(target), None
    except OSError as e:
        return r["seq"], False, "", 0, str(e)


def stage_documents(rows: DataFrame, root: str, **options: str) -> Staged:
    """Writes rows through the sink, as they are dealt, and commits them."""
    spark = rows.sparkSession
    ship(spark)
    spark.dataSource.register(DocumentSink)
    out = Staged(spark, local_path(root), uuid.uuid4().hex)
    os.makedirs(out.root, exist_ok=True)
    rows.write.format("gleaner_documents").mode("append").options(path=out.root, job=out.job, **options).save()
    return out


def stage_bodies(rows: DataFrame, root: str) -> Staged:
    """Stages documents (seq, section, filename, status, body, error); rows of one name are together, in order of seq."""
    ordered = rows.select("seq", "section", "filename", "status", "body", "error").repartition("section", "filename").sortWithinPartitions("section", "filename", "seq")
    return stage_documents(ordered, root)


def stage_downloads(rows: DataFrame, root: str, policy, strict: bool = False) -> Staged:
    """Downloads and stages documents (seq, section, url, document_id, fallback); those of one host are asked for in order of seq by one task."""
    from .turns import by_host

    ordered = by_host(rows.select("seq", "section", "url", "document_id", "fallback")).sortWithinPartitions("seq")
    return stage_documents(ordered, root, policy=json.dumps(asdict(policy)), strict=str(strict).lower())
