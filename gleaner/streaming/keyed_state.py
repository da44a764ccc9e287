"""The current entry of each key as the state of a stream.

The rule of ``registry.current``, event by event: of events other than skips the last
one by order stays, a skip stays only while its key has nothing else, and of skips the first
one.  A state holds one event and the order of the first one, however many events its key
has had; an event that comes again, or late, changes nothing that it should not.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..session import ship

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def folded(entry: tuple | None, event: tuple, order: list[int], status: int) -> tuple:
    """An entry (an event's columns, then the order of the first event) after one more event."""
    at = tuple(event[i] for i in order)
    if entry is None:
        return (*event, *at)
    own, first = entry[: len(event)], entry[len(event) :]
    was = tuple(own[i] for i in order)
    if event[status] == "skipped":
        wins = own[status] == "skipped" and at < was
    else:
        wins = own[status] == "skipped" or at > was
    return (*(event if wins else own), *min(first, at))


class _Entries(StatefulProcessor):
    def __init__(self, schema: str, names: list[str], order: list[int], status: int):
        self.schema, self.names, self.order, self.status = schema, names, order, status

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entry = handle.getValueState("entry", self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:
        before = entry = tuple(self.entry.get()) if self.entry.exists() else None
        for row in rows:
            entry = folded(entry, tuple(row), self.order, self.status)
        if entry != before:
            self.entry.update(entry)
            yield Row(**dict(zip(self.names, entry, strict=True)))

    def close(self) -> None:
        pass


@contextmanager
def _rocks(spark: SparkSession) -> Iterator[None]:
    """States are kept by RocksDB while a query is started."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def follow_entries(events: DataFrame, target: str, checkpoint: str, key: str = "doc_key", status: str = "status", order: tuple[str, ...] = ("seq",), once: bool = True) -> StreamingQuery:
    """Keeps the entries of a stream of events; those that a batch changes are written to target/batch=N.

    A batch that is replayed writes the same rows to the same place.  once: take what is
    there and end.
    """
    spark = events.sparkSession
    ship(spark)
    names = events.columns
    types = {f.name: f.dataType.simpleString() for f in events.schema}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in names), *(f"first_{c} {types[c]}" for c in order)])
    processor = _Entries(schema, [*names, *(f"first_{c}" for c in order)], [names.index(c) for c in order], names.index(status))
    changed = events.groupBy(key).transformWithState(processor, outputStructType=schema, outputMode="Update", timeMode="None")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = changed.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    with _rocks(spark):
        return (writer.trigger(availableNow=True) if once else writer).start()


def entries(spark: SparkSession, target: str, key: str = "doc_key") -> DataFrame:
    """The last state of each key that ``follow_entries`` has written."""
    rows = spark.read.parquet(target)
    rest = [c for c in rows.columns if c not in (key, "batch")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("_last")).select(key, "_last.*")
