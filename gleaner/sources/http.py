"""A batch data source ``gleaner_http``: URLs to responses, through ``spark.read``.

    register(spark)
    spark.read.format("gleaner_http").option("path", "/frontier").load()

The URLs come from the column url of the Parquet files below path, a mounted folder, or,
for a few, from the option urls, separated by white space.  Planning lists the
files and reads no URL; a partition reads those of its hosts, so all requests to a host
are made by one task, in the order of the files, and hosts take turns in it.  A URL counts
once.  Conditions on url are applied before anything is asked for; for that, ``register``
sets ``spark.sql.python.filterPushdown.enabled``, which Spark then asks for.

Other options: partitions, timeout, retries, backoff, delay, verify, user_agent.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from urllib.parse import urlsplit

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith

from ..schemas import RESPONSE
from .fetch import Policy, _opener, _row, request
from .turns import in_turn

#: Partitions, unless an option says otherwise, and URLs that are read from a file at once.
PARTITIONS, BATCH = 8, 16_384
_TESTS = {EqualTo: lambda url, v: url == v, In: lambda url, v: url in v, StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: str.__contains__}


def register(spark: SparkSession) -> None:
    """Makes the source known to a session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(HttpPages)


@dataclass
class Hosts(InputPartition):
    """The hosts whose hash, modulo the number of partitions, is this number."""

    number: int


class HttpPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gleaner_http"

    def schema(self) -> str:
        return RESPONSE

    def reader(self, schema) -> HttpReader:
        return HttpReader(self.options)


class HttpReader(DataSourceReader):
    def __init__(self, options):
        kinds = {"timeout": float, "retries": int, "backoff": float, "delay": float, "user_agent": str}
        given = {k: f(options[k]) for k, f in kinds.items() if options.get(k) is not None}
        if options.get("verify") is not None:
            given["verify"] = options["verify"].lower() != "false"
        self.policy = Policy(**given)
        self.path, self.urls = options.get("path"), (options.get("urls") or "").split()
        self.count = int(options.get("partitions") or PARTITIONS)
        self.wanted: list[tuple[type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if type(f) in _TESTS and f.attribute == ("url",):
                self.wanted.append((type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[Hosts]:
        return [Hosts(i) for i in range(self.count)]

    def _all(self) -> Iterator[str]:
        yield from self.urls
        if self.path:
            import pyarrow.dataset as ds

            files = sorted(os.path.join(d, f) for d, _, names in os.walk(self.path) for f in names if f.endswith(".parquet"))
            for file in files:
                for batch in ds.dataset(file).to_batches(columns=["url"], batch_size=BATCH):
                    yield from (u for u in batch.column("url").to_pylist() if u)

    def chosen(self, number: int) -> Iterator[str]:
        """The URLs of a partition that pass the conditions, each once."""
        seen: set[bytes] = set()
        for url in self._all():
            if zlib.crc32(urlsplit(url).netloc.encode()) % self.count == number and all(_TESTS[kind](url, value) for kind, value in self.wanted):
                key = blake2b(url.encode(), digest_size=16).digest()
                if key not in seen:
                    seen.add(key)
                    yield url

    def read(self, partition: Hosts) -> Iterator:
        opener = _opener(self.policy)
        for url in in_turn(self.chosen(partition.number), lambda u: urlsplit(u).netloc, self.policy.delay):
            yield _row(request(url, self.policy, opener))
