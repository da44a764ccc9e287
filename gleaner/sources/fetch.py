"""Fetchers: tables of URLs to tables of responses, and downloads to files.

A fetcher is anything with ``fetch(urls) -> DataFrame`` of the shape RESPONSE.  One
that also has ``stage(rows, root, strict)`` saves documents itself, chunk by chunk.
"""

from __future__ import annotations

import os
import re
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from contextlib import nullcontext
from dataclasses import dataclass, field
from typing import Protocol
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..functions.rules import HTML_ERROR, RETRY_METHODS, RETRY_STATUSES
from ..operators.responses import CHUNK
from ..schemas import RESPONSE
from .sink import Staged, stage_bodies, stage_downloads
from .turns import by_host, in_turn


class Fetcher(Protocol):
    def fetch(self, urls: DataFrame) -> DataFrame:
        """RESPONSE rows for the distinct values of the column url."""


@dataclass
class TableFetcher:
    """Responses out of a table; a URL that it lacks is answered by 404.

    Of a table that is stored in the order of its URLs only the range that the asked ones,
    which are few, span is read, and no response that is not asked for goes into an exchange.
    """

    responses: DataFrame
    ordered: bool = False

    def fetch(self, urls: DataFrame) -> DataFrame:
        asked, held = urls.select("url").distinct(), self.responses
        if self.ordered:
            ends = asked.agg(F.min("url").alias("least"), F.max("url").alias("most")).first()
            held = held.where(F.col("url").between(ends.least, ends.most)).join(asked, "url", "left_semi")
        found = asked.join(held, "url", "left")
        return found.select("url", F.coalesce("status", F.lit(404)).alias("status"), "headers", "body", "error")


@dataclass(frozen=True)
class Policy:
    """How requests are made.  Waits double from backoff * 2 on; a Retry-After header goes before."""

    user_agent: str = "gleaner/0.1"
    timeout: float = 30.0
    retries: int = 3
    backoff: float = 1.5
    longest_wait: float = 120.0
    delay: float = 0.4
    verify: bool = True
    headers: dict[str, str] = field(
        default_factory=lambda: {"Accept": "text/html,application/xhtml+xml,application/xml;q=0.9,*/*;q=0.8", "Accept-Language": "en-US,en;q=0.9", "Accept-Encoding": "gzip, deflate"}
    )

    def wait(self, attempt: int, after: str | None, status: int | None) -> float:
        """Seconds before a further attempt; attempt counts the failures so far."""
        if after and status in (413, 429, 503) and after.strip().isdigit():
            return float(after)
        return 0.0 if attempt < 2 else min(self.longest_wait, self.backoff * 2 ** (attempt - 1))


def _opener(policy: Policy):
    import ssl

    context = ssl.create_default_context()
    if not policy.verify:
        context.check_hostname = False
        context.verify_mode = ssl.CERT_NONE
    return urllib.request.build_opener(urllib.request.HTTPSHandler(context=context))


def chunks(answer, encoding: str | None, size: int = CHUNK) -> Iterator[bytes]:
    """The body of an open answer, uncompressed, of which a chunk is held at a time."""
    import zlib

    inflate = {"gzip": zlib.decompressobj(16 + zlib.MAX_WBITS), "deflate": zlib.decompressobj()}.get(encoding or "")
    first = True
    while piece := answer.read(size):
        if inflate is not None:
            try:
                piece = inflate.decompress(piece)
            except zlib.error:
                if not first or encoding != "deflate":
                    raise
                inflate = zlib.decompressobj(-zlib.MAX_WBITS)  # deflate without a header
                piece = inflate.decompress(piece)
            first = False
        if piece:
            yield piece
    if inflate is not None and (rest := inflate.flush()):
        yield rest


def exchange(url: str, policy: Policy, use: Callable, opener=None, sleep=time.sleep, method: str = "GET"):
    """use(status, headers, open answer, error) of the last attempt; an exhausted status is an answer, other faults are the error.

    The body is read by use alone, so an answer that is tried again, or whose body is
    not wanted, costs its headers.
    """
    opener = opener or _opener(policy)
    failures = 0
    while True:
        status, headers, answer, error = None, {}, None, None
        try:
            ask = urllib.request.Request(url, headers={"User-Agent": policy.user_agent, **policy.headers}, method=method)
            answer = opener.open(ask, timeout=policy.timeout)
        except urllib.error.HTTPError as e:
            answer = e
        except Exception as e:  # a fault of the network is data
            error = f"{type(e).__name__}: {e}"
        with answer if answer is not None else nullcontext():
            if answer is not None:
                status, headers = answer.status, {k.lower(): v for k, v in answer.headers.items()}
            again = method in RETRY_METHODS and (error is not None or status in RETRY_STATUSES)
            if not again or failures >= policy.retries:
                return use(status, headers, answer, error)
        failures += 1
        sleep(policy.wait(failures, headers.get("retry-after"), status))


def request(url: str, policy: Policy, opener=None, sleep=time.sleep, method: str = "GET") -> dict:
    """One response as a row of RESPONSE."""

    def whole(status, headers, answer, error) -> dict:
        body = None
        if answer is not None:
            try:
                body = b"".join(chunks(answer, headers.get("content-encoding")))
            except Exception as e:  # a body that breaks off
                error = f"{type(e).__name__}: {e}"
        return {"url": url, "status": status, "headers": headers, "body": body, "error": error}

    return exchange(url, policy, whole, opener, sleep, method)


_KIND = pa.schema([("url", pa.string()), ("status", pa.int32()), ("headers", pa.map_(pa.string(), pa.string())), ("body", pa.binary()), ("error", pa.string())])


def _row(r: dict) -> pa.RecordBatch:
    return pa.record_batch([pa.array([list(r["headers"].items()) if k == "headers" else r[k]], t) for k, t in zip(_KIND.names, _KIND.types, strict=True)], schema=_KIND)


@dataclass
class HttpFetcher:
    """Responses from the network; the URLs of a host are fetched one after another, with a delay, in one task, and other hosts of the task meanwhile."""

    policy: Policy = field(default_factory=Policy)

    def fetch(self, urls: DataFrame) -> DataFrame:
        policy = self.policy

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            opener = _opener(policy)
            each = (url for batch in batches for url in batch.column("url").to_pylist())
            for url in in_turn(each, lambda u: urlsplit(u).netloc, policy.delay):
                yield _row(request(url, policy, opener))

        return by_host(urls.select("url").distinct()).mapInArrow(run, RESPONSE)

    def stage(self, rows: DataFrame, root: str, strict: bool = False) -> Staged:
        """Stages the documents of rows (seq, section, url, document_id, fallback) below root.

        A document's name is known with the headers of its response; only then, and only
        if its file is not there, its body is read, a chunk at a time.  fallback is the
        name where the headers give none.
        """
        return stage_downloads(rows, root, self.policy, strict)


def body_text(body: bytes | None, kind: str | None) -> str | None:
    """A body as text by the charset of its content type.

    Without a charset a text type is ISO-8859-1, any other UTF-8; bytes that do not
    fit a charset are replaced.
    """
    if body is None:
        return None
    kind = kind or ""
    named = re.search(r"charset=[\"']?([\w.:-]+)", kind, re.I)
    charset = named[1] if named else "iso-8859-1" if kind.lower().startswith("text/") else "utf-8"
    try:
        return body.decode(charset, "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def content_type(headers: list[tuple[str, str]] | dict[str, str] | None) -> str | None:
    """The content type among the headers of a response."""
    return next((v for k, v in dict(headers or ()).items() if k.lower() == "content-type"), None)


@arrow_udf(T.StringType())
def _decoded(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for body, kind in columns:
        yield pa.array([body_text(b, k) for b, k in zip(body.to_pylist(), kind.to_pylist(), strict=True)], pa.string())


def page_text(body: Column, headers: Column) -> Column:
    """The text of a response."""
    return _decoded(body, F.coalesce(F.try_element_at(headers, F.lit("content-type")), F.try_element_at(headers, F.lit("Content-Type"))))


def write_chunks(folder: str, name: str, body: Callable[[], Iterator[bytes]]) -> tuple[bool, str, int, str | None]:
    """Writes one document atomically: (ok, filename, size, error).

    A file that is there and not empty stays and counts, and the body is not read; HTML
    fails; an empty body makes an empty file.  Each attempt writes to a name of its own,
    which takes the place of the target only while nothing stands there.
    """
    target = os.path.join(folder, name)
    part = f"{target}.{uuid.uuid4().hex}.part"
    filled = lambda: os.path.exists(target) and os.path.getsize(target) > 0
    try:
        if filled():
            return True, name, os.path.getsize(target), None
        begun = False
        os.makedirs(folder, exist_ok=True)
        with open(part, "wb") as f:
            for piece in body():
                if not begun and piece.lstrip().startswith((b"<!DOCTYPE", b"<html")):
                    os.remove(part)
                    return False, name, 0, HTML_ERROR
                begun = True
                f.write(piece)
        if filled():  # another one was faster
            os.remove(part)
        else:
            os.replace(part, target)
        return True, name, os.path.getsize(target), None
    except Exception as e:  # a fault of one file is data
        if os.path.exists(part):
            os.remove(part)
        return False, "", 0, str(e)


def write_body(folder: str, name: str, body: bytes | None) -> tuple[bool, str, int, str | None]:
    """Writes one document whose body is at hand."""
    whole = body or b""
    return write_chunks(folder, name, lambda: (whole[i : i + CHUNK] for i in range(0, len(whole), CHUNK)))


def write_documents(rows: DataFrame, root: str) -> DataFrame:
    """Results (DOWNLOAD) of writing rows (seq, section, filename, status, body, error) below root, a folder that all executors share.

    Rows of one file are written in order of seq, so the first of them stays.  The files
    appear only after all of them have been written (see ``sink``).
    """
    return stage_bodies(rows, root).publish()
