"""Ingest of user actions: validate, store idempotently, keep the rejects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from shoplens.operators.dated import KeyedTable, append_days
from shoplens.operators.tables import split_rejects, write_batch
from shoplens.streaming.runner import start_batches


def ingest(actions: DataFrame, rules: dict[str, Column], table: KeyedTable, rejects: str, checkpoint: str, *,
           once: bool = False) -> StreamingQuery:
    """Each micro-batch is merged into the table, partition by partition, and its rejects are appended by day.

    The checkpoint takes the place of the consumer's commit: it advances only after both writes.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = split_rejects(batch, rules)
            table.merge(good, batch_id)
            append_days(bad, rejects, table.ts, batch_id)
        finally:
            batch.unpersist()

    return start_batches(actions, store, checkpoint, once=once)


def store_rows(rows: DataFrame, table: str, checkpoint: str, *, mode: str = "append", once: bool = False,
               prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Write each micro-batch, after `prepare`, as a batch of a table."""
    return start_batches(rows, lambda batch, batch_id: write_batch(prepare(batch), table, batch_id), checkpoint,
                         mode=mode, once=once)
