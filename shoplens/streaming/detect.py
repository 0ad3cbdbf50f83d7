"""Inventory events to notifications, and spans to anomalies, as chained streams.

Finding the targets of an event needs several aggregations, so it runs per micro-batch and writes the attempts to a
log. A second query reads that log through the stateful gate. As with any at-least-once log, an attempt may arrive
twice after a failure; the duplicate gate then holds it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shoplens.operators import dated, notify, traces
from shoplens.operators.interest import PRICE_DROP_DAYS, RESTOCK_ACTIONS, relevant_actions
from shoplens.operators.tables import write_batch
from shoplens.streaming.runner import start_batches

ATTEMPT = T.StructType([
    T.StructField("attempt_id", T.StringType()), T.StructField("inventory_event_id", T.StringType()),
    T.StructField("user_id", T.LongType()), T.StructField("product_id", T.LongType()),
    T.StructField("notification_type", T.StringType()), T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()), T.StructField("rank", T.IntegerType()),
])


def log_attempts(events: DataFrame, actions: Callable[[], DataFrame], path: str, checkpoint: str, *,
                 cart_actions: list[str] = RESTOCK_ACTIONS, limit: int | None = None, once: bool = False) -> StreamingQuery:
    """Price drops and restocks of each micro-batch, with the users to tell, as batches of an attempt log; of a micro-batch,
    attempts that the daily cap must hold back may be left out.

    `actions` is called per micro-batch, so it sees what has been stored by then.
    """

    def detect(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            drops, back = notify.price_drops(batch), notify.restocks(batch)
            seen = relevant_actions(actions(), batch, PRICE_DROP_DAYS)
            of_drops, of_restocks = notify.first_attempts(drops, back, seen, cart_actions, limit)
            attempts = of_drops.unionByName(of_restocks)
            write_batch(attempts.select(*ATTEMPT.fieldNames()), path, batch_id)
        finally:
            batch.unpersist()

    return start_batches(events, detect, checkpoint, once=once)


FINDING = T.StructType([
    T.StructField("trace_id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("service_name", T.StringType()), T.StructField("operation_name", T.StringType()),
    T.StructField("duration_ms", T.LongType()), T.StructField("threshold_ms", T.LongType()),
    T.StructField("error_message", T.StringType()), T.StructField("span_count", T.LongType()),
])


def scan_spans(spans: DataFrame, span_log: str, anomaly_log: str, checkpoint: str, *,
               longest_us: int = traces.LONGEST_TRACE_US, once: bool = False) -> StreamingQuery:
    """Store spans by the hour, look at every trace the micro-batch touches as a whole, and store what is new.

    No trace may last longer than `longest_us`, so only the hours so long before and after the micro-batch are read back.
    """

    def scan(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated.append_spans(batch, span_log, batch_id)
        # Read back rather than derived again.
        stored = dated.spans_of_batch(spark, span_log, batch.schema, batch_id)
        first, last = stored.agg(F.min("start_us"), F.max("start_us")).first()
        found = spark.createDataFrame([], FINDING)
        if first is not None:
            touched = stored.select("trace_id").distinct()
            near = dated.spans_between(spark, span_log, batch.schema, first, last, longest_us, batch_id)
            found = traces.find_anomalies(near.join(touched, "trace_id", "left_semi"))
        if dated.exists(spark, anomaly_log):
            known = spark.read.schema(T.StructType([*FINDING.fields, T.StructField("batch_id", T.LongType())])).parquet(anomaly_log)
            found = traces.new_anomalies_only(found, known.where(F.col("batch_id") < batch_id).withColumn("is_bookmark", F.lit(False)))
        write_batch(found.select(*FINDING.fieldNames()), anomaly_log, batch_id)

    return start_batches(spans, scan, checkpoint, once=once)
