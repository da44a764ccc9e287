"""The registry: an append-only log of events, and views of it."""

from __future__ import annotations

import hashlib
import json
import re
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import CSV_COLUMNS, EXISTS_REASON, UNKNOWN_ERROR
from ..schemas import EVENT
from ..session import ship
from ..sources.files import replace_file
from ..sources.ordered import write_ordered


def current(events: DataFrame, key: str = "doc_key", status: str = "status", order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The latest event of each key, and first_seen, the order of its first one.

    A skip counts only where no other event of its key came before it.
    """
    rest = [c for c in events.columns if c != key]
    rank = F.struct(F.when(F.col(status) == "skipped", F.lit(0)).otherwise(F.lit(1)), *order)
    first = F.struct(*order)
    # Among skips the first stays, among all others the last does.
    kept = events.groupBy(key).agg(
        F.max_by(F.struct(*rest), rank).alias("_last"), F.min_by(F.struct(*rest), first).alias("_first"), F.max(F.when(F.col(status) == "skipped", 0).otherwise(1)).alias("_other"), F.min(first).alias("first_seen")
    )
    return kept.select(key, F.when(F.col("_other") == 1, F.col("_last")).otherwise(F.col("_first")).alias("_row"), F.col("first_seen")).select(key, "_row.*", "first_seen")


def split_downloaded(candidates: DataFrame, registry: DataFrame, files: DataFrame, key: str = "doc_key") -> tuple[DataFrame, DataFrame]:
    """(skipped, to_fetch) of candidates: those with a successful entry whose file is there and not empty, and the rest.

    registry: key, status, file_path (current entries); files: path, length.
    Catalyst broadcasts the small side by its statistics, or sorts and merges.
    """
    there = files.where("length > 0").select(F.col("path").alias("file_path"))
    done = registry.where("status = 'success' and file_path <> ''").join(there, "file_path", "left_semi").select(key)
    return candidates.join(done, key, "left_semi"), candidates.join(done, key, "left_anti")


def summary(registry: DataFrame) -> DataFrame:
    """Entries in total and by status."""
    of = lambda s: F.count_if(F.col("status") == s)
    return registry.agg(F.count("*").alias("total_tracked"), of("success").alias("successful_downloads"), of("failed").alias("failed_downloads"), of("skipped").alias("skipped"))


def success_events(rows: DataFrame) -> DataFrame:
    """Events of downloads that went well; what is missing is empty."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return rows.select(
        "seq", "doc_key", "document_id", "article_id", "section", "filename", F.concat_ws("/", "section", "filename").alias("file_path"), "file_size_bytes",
        text("article_title"), text("article_url"), text("download_url"), text("link_text"), F.lit("success").alias("status"), F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("string").alias("reason"), F.current_timestamp().alias("timestamp"),
    )


def failure_events(rows: DataFrame) -> DataFrame:
    """Events of downloads that failed: no file name, no path, size 0."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return rows.select(
        "seq", "doc_key", "document_id", "article_id", "section", F.lit("").alias("filename"), F.lit("").alias("file_path"), F.lit(0).cast("long").alias("file_size_bytes"),
        text("article_title"), text("article_url"), text("download_url"), text("link_text"), F.lit("failed").alias("status"),
        F.coalesce(F.nullif("error", F.lit("")), F.lit(UNKNOWN_ERROR)).alias("error"), F.lit(None).cast("string").alias("reason"), F.current_timestamp().alias("timestamp"),
    )


def skip_events(rows: DataFrame, reason: str = EXISTS_REASON) -> DataFrame:
    null = lambda c, t="string": F.lit(None).cast(t).alias(c)
    return rows.select(
        "seq", "doc_key", "document_id", "article_id", "section", null("filename"), null("file_path"), null("file_size_bytes", "long"), null("article_title"), null("article_url"),
        null("download_url"), null("link_text"), F.lit("skipped").alias("status"), null("error"), F.lit(reason).alias("reason"), F.current_timestamp().alias("timestamp"),
    )


class Registry:
    """A log of events in a folder, folded now and then into a snapshot of the current entries.

    A snapshot has one row for each key, bucketed and sorted by key, so that reading it, or
    joining it by key, needs no exchange on its side.  Each bucket is a partition of its
    own: ``base/vN/_buckets`` says for each one that has rows in which version it was written, M, and
    ``base/vM/bucket=B`` holds them, so a snapshot writes the buckets that events have
    touched and takes the others over as they are.  ``log/vN``
    holds the batches appended since and ``stream/vN/batch=M`` those that a stream brought (see
    ``streaming.registry_stream``); the greatest N whose snapshot is complete counts (0: no
    snapshot yet).  All events share one count of seq, whose last value stands in
    ``_head``.  So an append writes its batch and that number, and reads nothing
    of what was there before.
    """

    #: Seconds after which a lock is taken over from a writer that has not renewed it.
    LEASE = 600.0

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        """buckets: of the snapshots of a new registry; not fewer than the partitions of a shuffle, or joins deal it anew."""
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = buckets or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self._known: set[int] = set()  # snapshots that the session has as tables

    def _at(self, name: str = ""):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    @property
    def _files(self):
        return self._at().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _folders(self, name: str) -> list[str]:
        return sorted(f.getPath().getName() for f in self._files.listStatus(self._at(name))) if self._files.exists(self._at(name)) else []

    def _get(self, name: str) -> dict | None:
        """A small JSON file of the folder."""
        if not self._files.exists(self._at(name)):
            return None
        stream = self._files.open(self._at(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _put(self, name: str, value: dict) -> None:
        """Sets it at once: written beside its place and renamed over it."""
        beside = f"{name}.{uuid.uuid4().hex}"
        stream = self._files.create(self._at(beside), True)
        stream.write(bytearray(json.dumps(value).encode()))
        stream.close()
        replace_file(self.spark, f"{self.path}/{beside}", f"{self.path}/{name}")

    # ------------------------------------------------------------ reading

    def versions(self) -> list[int]:
        """The complete snapshots, ascending."""
        return sorted(int(f[1:]) for f in self._folders("base") if f[1:].isdigit() and self._files.exists(self._at(f"base/{f}/_buckets")))

    @property
    def version(self) -> int:
        return (self.versions() or [0])[-1]

    def base(self) -> DataFrame | None:
        """The snapshot, one row for each key; bucketed by key."""
        if not (version := self.version):
            return None
        name = self._name(version)
        if version not in self._known or not self.spark.catalog.tableExists(name):
            shape = f"{EVENT}, first_seen struct<seq: bigint>, bucket int"
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({shape}) USING parquet PARTITIONED BY (bucket) CLUSTERED BY (doc_key) SORTED BY (doc_key) INTO {self._get('_head')['buckets']} BUCKETS LOCATION '{self.path}/base/v{version}'")
            parts = [f"PARTITION (bucket={b}) LOCATION '{self.path}/base/v{v}/bucket={b}'" for b, v in self._buckets(version).items()]
            if parts:
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts)}")
            self._known.add(version)
        return self.spark.table(name)

    def _name(self, version: int) -> str:
        return f"gleaner_{hashlib.sha256(f'{self.path}/{version}'.encode()).hexdigest()[:24]}"

    def _buckets(self, version: int) -> dict[int, int]:
        """The buckets of a snapshot that have rows, and the version in which each was written."""
        return {int(b): v for b, v in (self._get(f"base/v{version}/_buckets") or {}).items()}

    def recent(self, but_batch: int | None = None) -> DataFrame:
        """The events since the snapshot; but_batch leaves out one batch of a stream."""
        version = self.version
        batches = [f for f in self._folders(f"stream/v{version}") if self._files.exists(self._at(f"stream/v{version}/{f}/_SUCCESS")) and f != f"batch={but_batch}"]
        paths = [f"{self.path}/stream/v{version}/{f}" for f in batches]
        if self._files.exists(self._at(f"log/v{version}/_SUCCESS")):
            paths.append(f"{self.path}/log/v{version}")
        return reduce(DataFrame.unionByName, [self.spark.read.schema(EVENT).parquet(p) for p in paths]) if paths else self.spark.createDataFrame([], EVENT)

    def load(self) -> DataFrame:
        """The current entry of each key.  Only the events since the snapshot are dealt by key."""
        return self._merged(self.base(), current(self.recent()))

    @staticmethod
    def _merged(base: DataFrame | None, recent: DataFrame) -> DataFrame:
        if base is None:
            return recent
        old, new = F.struct(*(F.col(f"o.{c}").alias(c) for c in recent.columns)), F.struct(*(F.col(f"n.{c}").alias(c) for c in recent.columns))
        both = base.select(*recent.columns).alias("o").join(recent.alias("n"), F.col("o.doc_key") == F.col("n.doc_key"), "full")
        # A later skip changes nothing.
        newer = F.col("o.doc_key").isNull() | F.coalesce(F.col("n.status") != "skipped", F.lit(False))
        rows = both.select(F.when(newer, new).otherwise(old).alias("_row"), F.coalesce("o.first_seen", "n.first_seen").alias("_seen"))
        return rows.select("_row.*", "_seen").withColumn("first_seen", F.col("_seen")).drop("_seen")

    def split(self, candidates: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``split_downloaded`` by this registry: the snapshot stays as it is dealt, candidates and recent events come to it."""
        base, recent = self.base(), current(self.recent()).select("doc_key", F.col("status").alias("_new"), F.col("file_path").alias("_new_path"))
        known = candidates.select("doc_key").distinct()
        if base is None:
            entries = known.join(recent, "doc_key").select("doc_key", F.col("_new").alias("status"), F.col("_new_path").alias("file_path"))
        else:
            met = known.join(base.select("doc_key", "status", "file_path").hint("merge"), "doc_key", "left").join(recent, "doc_key", "left")
            newer = F.col("_new").isNotNull() & (F.col("status").isNull() | (F.col("_new") != "skipped"))
            entries = met.select("doc_key", F.when(newer, F.col("_new")).otherwise(F.col("status")).alias("status"), F.when(newer, F.col("_new_path")).otherwise(F.col("file_path")).alias("file_path"))
        return split_downloaded(candidates, entries, files)

    def last_seq(self, but_batch: int | None = None) -> int:
        """The seq of the last event.  A batch that is written again takes numbers of its own."""
        return (self._get("_head") or {"seq": 0})["seq"]

    # ------------------------------------------------------------ writing

    @contextmanager
    def writing(self, wait: float = 60.0) -> Iterator[None]:
        """One writer at a time, so that no two take the same seq: a lock file with an owner and a time, which goes at the end.

        A lock whose owner has not renewed it for LEASE seconds is taken over, so a
        killed driver does not block later runs.
        """
        lock, until, owner = self._at("_writing"), time.monotonic() + wait, uuid.uuid4().hex
        self._files.mkdirs(self._at())
        while not self._files.createNewFile(lock):
            try:
                since = self._files.getFileStatus(lock).getModificationTime() / 1000
                if time.time() - since > self.LEASE and self._files.rename(lock, self._at(f"_stale-{owner}")):  # one of several that wait gets it
                    self._files.delete(self._at(f"_stale-{owner}"), False)
                    continue
            except Exception:  # it went meanwhile
                if self._files.exists(lock):
                    raise
                continue
            if time.monotonic() > until:
                raise TimeoutError(f"{lock} is there: another writer is at work, or one has ended without removing it less than {self.LEASE:.0f} seconds ago")
            time.sleep(0.1)
        ended = threading.Event()

        def renew() -> None:
            while not ended.wait(self.LEASE / 4):
                self._files.setTimes(lock, int(time.time() * 1000), -1)

        thread = threading.Thread(target=renew, daemon=True)
        thread.start()
        try:
            yield
        finally:
            ended.set()
            thread.join()
            self._files.delete(lock, False)

    def _shaped(self, events: DataFrame, base: int) -> DataFrame:
        shape = self.spark.createDataFrame([], EVENT)
        return events.withColumn("seq", F.col("seq") + F.lit(base + 1)).select(*shape.columns).to(shape.schema)

    def _write(self, events: DataFrame, path: str, mode: str) -> None:
        """Writes events; their seq counts from the last one, which is set before, so that a number is never given twice."""
        head = self._get("_head") or {"seq": 0, "buckets": self.buckets}
        seen = Observation()
        rows = self._shaped(events, head["seq"]).observe(seen, F.max("seq").alias("last"))
        rows.write.mode(mode).parquet(f"{self.path}/{path}")
        self._put("_head", head | {"seq": max(head["seq"], seen.get["last"] or 0)})

    def append(self, events: DataFrame) -> None:
        """Adds a batch; its seq counts from the last one there.  Errors are raised."""
        with self.writing():
            self._write(events, f"log/v{self.version}", "append")

    def append_batch(self, events: DataFrame, number: int) -> None:
        """Sets a stream's batch of that number; written again after a failure it takes the place of the first attempt.

        A batch that a snapshot holds already is not counted again.
        """
        with self.writing():
            if number > (self._get("_head") or {}).get("folded", -1):
                self._write(events, f"stream/v{self.version}/batch={number}", "overwrite")

    def compact(self) -> None:
        """Folds the events since the last snapshot, appended and streamed, into a new one.

        Only the buckets of keys that had events are read and written.  The snapshot counts
        from the moment its list of buckets is there, and the one before stays until the next
        time, so a reader finds all entries at any time.
        """
        with self.writing():
            version = self.version
            head = self._get("_head")
            if head is None:
                return
            at, name = f"{self.path}/base/v{version + 1}", f"gleaner_new_{uuid.uuid4().hex}"
            batches = [int(f.partition("=")[2]) for f in self._folders(f"stream/v{version}")]
            self._put("_head", head | {"folded": max([head.get("folded", -1), *batches]), "buckets": head["buckets"]})
            n, shape = head["buckets"], self.spark.createDataFrame([], EVENT)
            bucket = F.pmod(F.hash("doc_key"), F.lit(n))  # as a bucketed table deals its rows
            recent = self.recent()
            touched = [r.bucket for r in recent.select(bucket.alias("bucket")).distinct().collect()]  # n at most
            base = self.base()
            if base is not None:
                base = base.where(F.col("bucket").isin(touched))
            rows = self._merged(base, current(recent)).select(*shape.columns, F.struct(F.col("first_seen.seq").alias("seq")).alias("first_seen"), bucket.alias("bucket"))
            self._files.delete(self._at(f"base/v{version + 1}"), True)  # of an attempt that broke off
            # A task for each bucket writes one file, so sorted reads need no further sort.
            rows.repartition(n, "doc_key").write.partitionBy("bucket").bucketBy(n, "doc_key").sortBy("doc_key").option("path", at).saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")
            self._files.mkdirs(self._at(f"base/v{version + 1}"))
            self._put(f"base/v{version + 1}/_buckets", self._buckets(version) | dict.fromkeys(touched, version + 1))
            self._forget()
            for kind in ("log", "stream"):
                for f in self._folders(kind):
                    if f[1:].isdigit() and int(f[1:]) < version:
                        self._files.delete(self._at(f"{kind}/{f}"), True)

    def _forget(self) -> None:
        """Deletes all snapshots but the last two, and the buckets that these do not have."""
        versions = self.versions()
        used = {f"v{v}/bucket={b}" for kept in versions[-2:] for b, v in self._buckets(kept).items()}
        for old in versions[:-2]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(old)}")
            self._files.delete(self._at(f"base/v{old}/_buckets"), False)
        for f in self._folders("base"):
            there = [b for b in self._folders(f"base/{f}") if b.startswith("bucket=")]
            for b in there:
                if f"{f}/{b}" not in used:
                    self._files.delete(self._at(f"base/{f}/{b}"), True)
            if f[1:].isdigit() and int(f[1:]) not in versions[-2:] and not any(f"{f}/{b}" in used for b in there):
                self._files.delete(self._at(f"base/{f}"), True)

    def export_rows(self) -> DataFrame:
        """The columns of the CSV form, and first_seen, the order in which keys were first seen."""
        at = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
        rows = self.load().withColumns({"key": F.col("doc_key"), "timestamp": at})
        return rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in CSV_COLUMNS), "first_seen")

    def export_csv(self, target: str) -> None:
        """One CSV file in the order in which keys were first seen, moved into place."""
        quoted = lambda c: F.when(F.col(c).rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.col(c))
        line = F.concat_ws(",", *(quoted(c) for c in CSV_COLUMNS))
        write_ordered(self.export_rows().select("first_seen", line.alias("value")), "first_seen", target, "\r\n", ",".join(CSV_COLUMNS) + "\r\n")

    def export_json(self, target: str) -> None:
        """One JSON object of all entries by key, in the same order, in UTF-8, indented by two."""
        rows = self.load()
        rows = rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
        # A value as JSON is that of an object with one member, without the rest.
        value = lambda c: F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}), r"(?s)^\{\"v\":(.*)\}$", 1)
        member = lambda c: F.concat(F.lit(f'    "{c}": '), value(c))
        skipped = F.concat_ws(",\n", *(member(c) for c in _SKIPPED))
        other = F.concat_ws(",\n", *(member(c) for c in rows.columns if c not in ("seq", "doc_key", "first_seen", "reason")))
        entry = F.concat(F.lit("\n  "), value("doc_key"), F.lit(": {\n"), F.when(F.col("status") == "skipped", skipped).otherwise(other), F.lit("\n  }"))
        write_ordered(rows.select("first_seen", entry.alias("value")), "first_seen", target, ",", "{", "\n}", ended=False)


#: Members of a skipped entry of the JSON form.
_SKIPPED = ("document_id", "article_id", "section", "status", "reason", "timestamp")
_ENTRY = "struct<document_id:string,article_id:string,section:string,filename:string,file_path:string,file_size_bytes:bigint,article_title:string,article_url:string,download_url:string,link_text:string,status:string,error:string,reason:string,timestamp:timestamp>"
#: The first line of an entry, by its indentation; a line break inside a string is escaped.
_BEGIN = re.compile(r'^  "(?:[^"\\]|\\.)*": \{$')


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of the lines (value, at) of some splits of a file: at, i, text, and edge: 1 for a split's last one, which may go on, and -1 for what comes before its first one."""

    def row(at: int, i: int, lines: list[str], edge: int) -> tuple:
        return at, i, "\n".join(lines), edge

    split, i, lines, begun = None, 0, [], False
    for batch in batches:
        out = []
        for line, at in zip(batch.column("value").to_pylist(), batch.column("at").to_pylist(), strict=True):
            if at != split:
                if split is not None:
                    out.append(row(split, i, lines, 1 if begun else -1))
                split, i, lines, begun = at, 0, [], False
            if _BEGIN.match(line):
                out.append(row(at, i, lines, 0 if begun else -1))
                i, lines, begun = i + 1, [], True
            lines.append(line)
        if out:
            yield _rows(out)
    if split is not None:
        yield _rows([row(split, i, lines, 1 if begun else -1)])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.int32()), strict=True)], names=["at", "i", "text", "edge"])


def import_json(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a registry's JSON form, indented by two, in order; a file that can't be read as such gives none.

    Tasks read splits of the file, each from the first line of an entry on.  Of a split
    only its first and its last entry pass through the driver, to be put together.
    """
    ship(spark)
    none = spark.createDataFrame([], f"seq long, doc_key string, e {_ENTRY}").select("seq", "doc_key", "e.*")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("at"))
    found = lines.mapInArrow(_pieces, "at long, i long, text string, edge int")
    ends = sorted(found.where("edge <> 0").collect(), key=lambda r: (r.at, r.i))
    # What comes before a split's first entry ends the last one of the splits before.
    whole: list[tuple[int, int, str]] = []
    outer = ""
    for r in ends:
        if r.edge == 1:
            whole.append((r.at, r.i, r.text))
        elif whole:
            whole[-1] = (*whole[-1][:2], f"{whole[-1][2]}\n{r.text}" if r.text else whole[-1][2])
        else:
            outer += r.text
    if not whole or outer.strip() != "{" or not (last := whole[-1][2].rstrip()).endswith("}"):
        return none
    whole[-1] = (*whole[-1][:2], last[:-1])
    every = found.where("edge = 0").select("at", "i", "text").unionByName(spark.createDataFrame(whole, "at long, i long, text string"))
    body = F.regexp_replace("text", r",?\s*\z", "")
    text = F.concat(F.lit("{"), body, F.lit("}"))
    entry = F.when(F.try_parse_json(text).isNotNull(), F.from_json(text, f"map<string,{_ENTRY}>"))
    read = every.select("at", "i", F.get(F.map_entries(entry), F.lit(0)).alias("e"))
    counts, base = [], 0
    for r in sorted(read.groupBy("at").agg(F.count("*").alias("n"), F.count_if(F.col("e.value").isNull()).alias("bad")).collect(), key=lambda r: r.at):  # a row for each split
        if r.bad:
            return none
        counts.append((r.at, base))
        base += r.n
    bases = spark.createDataFrame(counts, "at long, base long")
    return read.join(F.broadcast(bases), "at").select((F.col("base") + F.col("i") - 1).alias("seq"), F.col("e.key").alias("doc_key"), "e.value.*")
