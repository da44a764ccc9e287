"""Politeness: requests to one host keep their delay, those to other hosts go on meanwhile."""

from __future__ import annotations

import heapq
import time
from collections import deque
from collections.abc import Callable, Iterator
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Row = TypeVar("Row")
#: Rows that a task looks ahead for hosts whose turn it is.
AHEAD = 1024


def host(url: str | Column) -> Column:
    """The host, with its port, of a column of URLs."""
    return F.regexp_extract(url, "^[a-zA-Z]+://([^/?#]*)", 1)


def in_turn(rows: Iterator[Row], host_of: Callable[[Row], str], delay: float, ahead: int = AHEAD, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> Iterator[Row]:
    """rows in an order in which each is due: a host's next row comes ``delay`` seconds after its last one was done, at the earliest.

    Hosts wait in a heap of their next times, so a task sleeps only if no host of the
    next ``ahead`` rows may be asked.  Rows of one host keep their order.  A row counts
    as done when the next one is asked for.
    """
    if not delay:
        yield from rows
        return
    queues: dict[str, deque[Row]] = {}
    heap: list[tuple[float, int, str]] = []  # time, number of arrival, host
    last: dict[str, float] = {}  # hosts that have been asked within the delay
    arrivals, held, more = 0, 0, True
    while True:
        while more and held < ahead:
            row = next(rows, None)
            if row is None:
                more = False
                break
            own = host_of(row)
            if own not in queues:
                queues[own] = deque()
                heapq.heappush(heap, (last[own] + delay if own in last else 0.0, arrivals, own))
                arrivals += 1
            queues[own].append(row)
            held += 1
        if not heap:
            return
        due, _, own = heapq.heappop(heap)
        if (wait := due - clock()) > 0:
            sleep(wait)
        held -= 1
        yield queues[own].popleft()
        last[own] = now = clock()
        if queues[own]:
            heapq.heappush(heap, (now + delay, arrivals, own))
            arrivals += 1
        else:
            del queues[own]
        if len(last) > 2 * ahead:
            last = {h: t for h, t in last.items() if now - t < delay}


def by_host(rows: DataFrame, url: str = "url", parts: int | None = None) -> DataFrame:
    """rows dealt so that a host is in one task, and hosts with more than a task's share of the rows in tasks of their own as far as there are tasks.

    There are at most as many such hosts as tasks; they are dealt one after another, the
    largest first, and all others by their hash.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("__host", host(url))
    seen = Observation()
    counts = rows.groupBy("__host").agg(F.count("*").alias("n")).observe(seen, F.sum("n").alias("total"))
    largest = counts.orderBy(F.col("n").desc(), "__host").limit(parts).collect()
    heavy = [r for r in largest if r.n * parts > seen.get["total"]] if parts > 1 else []  # fewer than parts
    place = F.pmod(F.xxhash64("__host"), F.lit(parts)).cast("int")
    if heavy:
        own = spark.createDataFrame([(r[0], i) for i, r in enumerate(heavy)], "__host string, __place int")
        rows = rows.join(F.broadcast(own), "__host", "left")
        light = F.lit(len(heavy)) + F.pmod(F.xxhash64("__host"), F.lit(parts - len(heavy))) if len(heavy) < parts else place
        place = F.coalesce("__place", light.cast("int"))
    return rows.repartitionById(parts, place).drop("__host", "__place")
