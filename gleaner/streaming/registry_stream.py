"""Registry upkeep as a stream: batches of events appended as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.registry import Registry


def follow(events: DataFrame, store: Registry, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends a stream of events (EVENT) to a registry, where ``Registry.load`` sees them.

    A batch that is replayed after a failure takes the place of its first attempt, so it
    is not counted twice; its events come after all others that are there then.
    once: take what is there and end.
    """
    writer = events.writeStream.foreachBatch(store.append_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
