"""Counts of a step while it runs: tasks from Spark's status, rows from small files of the tasks.

A task of the document sink says at most every ``TICK`` seconds what it has done so far, in a
file named by its partition, which takes the place of the last one at once.  An attempt
that is made again goes on in the same file, so nothing is counted twice.
"""

from __future__ import annotations

import json
import os
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LIVE, TICK, COUNTS = "live", 0.5, ("rows", "ok", "bytes")
_GROUP = "spark.jobGroup.id"


class Ticker:
    """What one task has done, for others to read."""

    def __init__(self, folder: str, partition: int, clock: Callable[[], float] = time.monotonic):
        self.path, self.clock = os.path.join(folder, LIVE, str(partition)), clock
        self.rows = self.ok = self.bytes = 0
        self.said = float("-inf")

    def add(self, ok: bool, size: int) -> None:
        self.rows, self.ok, self.bytes = self.rows + 1, self.ok + ok, self.bytes + size
        if self.clock() - self.said >= TICK:
            self.say()

    def say(self) -> None:
        self.said = self.clock()
        os.makedirs(os.path.dirname(self.path), exist_ok=True)
        part = f"{self.path}.{uuid.uuid4().hex}.part"
        with open(part, "w", encoding="utf-8") as f:
            json.dump([self.rows, self.ok, self.bytes], f)
        os.replace(part, self.path)


def counted(jobs: str) -> dict[str, int]:
    """Sums of what the tasks of all jobs below a folder have said."""
    total = dict.fromkeys(COUNTS, 0)
    for job in os.listdir(jobs) if os.path.isdir(jobs) else ():
        at = os.path.join(jobs, job, LIVE)
        try:
            names = [n for n in os.listdir(at) if n.isdigit()]
        except OSError:  # it says nothing, or has just ended
            continue
        for name in names:
            try:
                with open(os.path.join(at, name), encoding="utf-8") as f:
                    said = json.load(f)
            except OSError:
                continue
            for k, n in zip(COUNTS, said, strict=True):
                total[k] += n
    return total


def tasks(spark: SparkSession, group: str) -> dict[str, int]:
    """Tasks of the jobs of a group: those that are done, and those of all its stages known so far."""
    status = spark.sparkContext.statusTracker()
    jobs = [status.getJobInfo(j) for j in status.getJobIdsForGroup(group)]
    stages = [status.getStageInfo(s) for s in {s for j in jobs if j is not None for s in j.stageIds}]
    known = [s for s in stages if s is not None]
    return {"tasks_done": sum(s.numCompletedTasks for s in known), "tasks": sum(s.numTasks for s in known)}


@contextmanager
def watched(spark: SparkSession, tell: Callable[[dict], None], every: float, counts: Callable[[], dict] = dict) -> Iterator[None]:
    """While the block runs, a thread calls tell each ``every`` seconds with the tasks of the block's jobs and with counts().

    The jobs are told apart by a group of their own, in which they run; the group that the
    caller had is put back afterwards.  No call comes after the block has ended.
    """
    context = spark.sparkContext
    before, group = context.getLocalProperty(_GROUP), f"gleaner-{uuid.uuid4().hex}"
    over = threading.Event()

    def watch() -> None:
        while not over.wait(every):
            said = {**tasks(spark, group), **counts()}
            if not over.is_set():
                tell(said)

    thread = threading.Thread(target=watch, daemon=True)
    context.setLocalProperty(_GROUP, group)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()
        context.setLocalProperty(_GROUP, before)
