"""Starting and draining streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, *,
                  mode: str = "append", once: bool = False) -> StreamingQuery:
    """Run `handle` on every micro-batch; `once` processes what is there and ends.

    `handle` must be idempotent per batch id: after a failure the same batch is delivered again.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def drain(query: StreamingQuery) -> None:
    query.awaitTermination()
