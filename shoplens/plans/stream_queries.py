"""Streaming forms, run over what is there and read back from the tables they write."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.operators import notify, tables
from shoplens.operators.dated import KeyedTable, read_days
from shoplens.operators.interest import MAX_USERS
from shoplens.plans.action_queries import e4, e4_sql
from shoplens.plans.notify_queries import CART_TYPES, DROP_TYPES
from shoplens.plans.registry import (
    ACTIONS, ALPHA, ATTEMPTS, CART_ACTIONS, DIMS, DROPS, FOLD, INVENTORY, NOTIFICATIONS, RESTOCKS, SPANS, VECTORS,
    gate_sql, query, unit_sql)
from shoplens.plans.trace_queries import FOUND
from shoplens.schemas import ACTION_TYPES
from shoplens.session import scratch_path
from shoplens.sources import adapters as A
from shoplens.sources import streams
from shoplens.streaming.detect import ATTEMPT, FINDING, log_attempts, scan_spans
from shoplens.streaming.gate_state import gate_stream
from shoplens.streaming.ingest import ingest, store_rows
from shoplens.streaming.preference_state import preference_stream
from shoplens.streaming.runner import drain


def event_stream(spark, d):
    # As a pattern, the path may be one file or a folder of files.
    return streams.read_files(spark, f"{d}/events.parquet*", streams.EVENTS_SCHEMA)


ROWS_A_FILE = 200_000


def event_files(spark, d, batches=3):
    """The events as a stream of several micro-batches, so that state and tables are carried over.

    A trace lies in one file: what is found in a part of it would stand, whatever the rest. A micro-batch has more files
    the more events there are, so that as many tasks write and read it.
    """
    path, events = scratch_path(spark, "events"), A.table(spark, d, "events")
    trace = F.call_function("div", F.col("event_id"), F.lit(A.SPANS_PER_TRACE))
    a_batch = max(1, -(-events.count() // (batches * ROWS_A_FILE)))
    events.repartitionByRange(batches * a_batch, trace).write.parquet(path)
    return streams.read_files(spark, path, streams.EVENTS_SCHEMA, files_per_trigger=a_batch)


def _paths(spark, *names):
    root = scratch_path(spark, "stream")
    return [f"{root}/{n}" for n in names]


@query("read_notifications", NOTIFICATIONS,
       sql="SELECT notification_id, event_id, user_id, unnest(channels) AS channel FROM notes")
def _(spark, d):
    out, checkpoint = _paths(spark, "out", "checkpoint")
    rows = notify.deliveries(A.notifications_of(event_stream(spark, d))).select(
        "notification_id", "event_id", "user_id", "channel")
    drain(store_rows(rows, out, checkpoint, once=True))
    return spark.read.parquet(out).drop("batch_id")


@query("ingest_stream", ACTIONS, sql=f"""
SELECT trace_id, event_id, user_id, product_id, action_type, true AS stored FROM (
  SELECT * REPLACE (concat('T', event_id // 2) AS trace_id) FROM ua WHERE action_type IN {tuple(ACTION_TYPES)}
  QUALIFY row_number() OVER (PARTITION BY event_id // 2 ORDER BY ts DESC, event_id DESC) = 1)
UNION ALL SELECT concat('T', event_id // 2), event_id, user_id, product_id, action_type, false FROM ua
WHERE action_type NOT IN {tuple(ACTION_TYPES)}""")
def _(spark, d):
    table, rejects, checkpoint = _paths(spark, "table", "rejects", "checkpoint")
    actions = A.user_actions_of(event_files(spark, d)).withColumn(
        "trace_id", F.concat(F.lit("T"), F.call_function("div", F.col("event_id"), F.lit(2))))
    table = KeyedTable(table, actions.schema, "trace_id", "ts", ("ts", "event_id"), buckets=2, newest_batch_wins=False)
    drain(ingest(actions, tables.action_rules(ACTION_TYPES), table, rejects, checkpoint, once=True))
    stored = table.read(spark)
    columns = ["trace_id", "event_id", "user_id", "product_id", "action_type"]
    return stored.select(*columns, F.lit(True).alias("stored")).unionByName(
        read_days(spark, rejects, actions.schema, "ts").select(*columns, F.lit(False).alias("stored")))


def _taste_table(spark, d, backup=None):
    out, checkpoint = _paths(spark, "taste", "checkpoint")
    updates = preference_stream(A.user_actions_of(event_stream(spark, d)), A.product_vectors(spark, d), DIMS, backup)
    drain(store_rows(updates, out, checkpoint, mode="update", once=True))
    current = tables.read_current(spark, out, "user_id", ["updated_at"], updates.schema)
    return current.select("user_id", "action_count", e4(F.col("preference_vector")).alias("vector_e4"))


@query("preference_fold_stream", ACTIONS, VECTORS, FOLD,
       sql=f"SELECT user_id, action_count, {e4_sql('preference_vector')} AS vector_e4 FROM prefs")
def _(spark, d):
    return _taste_table(spark, d)


@query("preference_state", ACTIONS, VECTORS, f"""/*recursive*/
steps AS (SELECT user_id, {ALPHA} AS alpha, CAST(product_vector AS DOUBLE[]) AS p,
            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM ua JOIN vectors USING (product_id)),
fold AS (SELECT product_id AS user_id, 0::BIGINT AS rn, CAST(product_vector AS DOUBLE[]) AS v, 1 AS restored FROM vectors
           WHERE product_id IN (SELECT user_id FROM steps)
         UNION ALL SELECT user_id, rn, {unit_sql('p')}, 0 FROM steps
           WHERE rn = 1 AND user_id NOT IN (SELECT product_id FROM vectors)
         UNION ALL
         SELECT s.user_id, s.rn, CASE WHEN s.alpha = 0 THEN f.v ELSE
           {unit_sql('list_transform(list_zip(f.v, s.p), lambda z: z[1] * (1 - s.alpha) + z[2] * s.alpha)')} END, f.restored
         FROM fold f JOIN steps s ON s.user_id = f.user_id AND s.rn = f.rn + 1)""", sql=f"""
SELECT user_id, max(rn) + max(restored) AS action_count, {e4_sql('arg_max(v, rn)')} AS vector_e4 FROM fold GROUP BY user_id""")
def _(spark, d):
    """Users start from a stored vector: that of the product with their number, where there is one."""
    backup = A.product_vectors(spark, d).select(
        F.col("product_id").alias("user_id"), F.col("product_vector").alias("preference_vector"),
        F.lit(None).cast("bigint").alias("action_count"))
    return _taste_table(spark, d, backup)


def _gated(spark, d, **kw):
    out, checkpoint = _paths(spark, "admitted", "checkpoint")
    admitted = gate_stream(A.attempts_of(event_stream(spark, d)), **kw)
    drain(store_rows(admitted, out, checkpoint, once=True))
    return spark.read.parquet(out).select(
        "attempt_id", "user_id", F.col("product_id").cast("bigint").alias("product_id"), "notification_type", "ts", "seq")


@query("daily_gate", ATTEMPTS, gate_sql(),
       sql="SELECT attempt_id, user_id, product_id, notification_type, ts, seq FROM capped")
def _(spark, d):
    return _gated(spark, d, hours=None)


@query("can_send_stream", ATTEMPTS, gate_sql(),
       sql="SELECT attempt_id, user_id, product_id, notification_type, ts, seq FROM admitted")
def _(spark, d):
    return _gated(spark, d)


BOTH_ATTEMPTS = f"""
drop_matches AS (SELECT e.inventory_event_id, e.product_id, e.ts, e.seq, a.user_id, count(*) AS n, 'PRICE_DROP' AS notification_type
  FROM drops e JOIN ua a ON a.product_id = e.product_id AND a.action_type IN ({DROP_TYPES})
    AND a.ts <= e.ts AND a.ts >= e.ts - INTERVAL 30 DAY GROUP BY ALL),
back_matches AS (SELECT e.inventory_event_id, e.product_id, e.ts, e.seq, a.user_id, count(*) AS n, 'BACK_IN_STOCK' AS notification_type
  FROM restocks e JOIN ua a ON a.product_id = e.product_id AND a.action_type IN ({CART_TYPES})
    AND a.ts <= e.ts AND a.ts >= e.ts - INTERVAL 7 DAY GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY inventory_event_id ORDER BY n DESC, user_id) AS rank
  FROM (FROM drop_matches UNION ALL FROM back_matches)),
attempts AS (SELECT concat_ws('|', inventory_event_id, user_id) AS attempt_id, user_id, product_id, notification_type, ts,
  seq * 2147483648 + rank AS seq FROM ranked WHERE rank <= 10000)"""


@query("detect_stream", ACTIONS, INVENTORY, DROPS, RESTOCKS, BOTH_ATTEMPTS, gate_sql(),
       sql="SELECT attempt_id, user_id, product_id, notification_type, ts, seq FROM admitted")
def _(spark, d):
    log, out, first, second = _paths(spark, "attempts", "admitted", "checkpoint-1", "checkpoint-2")
    drain(log_attempts(A.inventory_events_of(event_stream(spark, d)), lambda: A.user_actions(spark, d), log, first,
                       cart_actions=CART_ACTIONS, limit=MAX_USERS, once=True))
    drain(store_rows(gate_stream(streams.read_files(spark, log, ATTEMPT)), out, second, once=True))
    return spark.read.parquet(out).select(
        "attempt_id", "user_id", F.col("product_id").cast("bigint").alias("product_id"), "notification_type", "ts", "seq")


@query("deliver_stream", NOTIFICATIONS, sql="""
SELECT notification_id, event_id, user_id, CASE WHEN list_has_any(channels, ['FAX']) THEN 'FAILED' ELSE 'SENT' END AS status FROM notes
QUALIFY row_number() OVER (PARTITION BY notification_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, d):
    out, checkpoint = _paths(spark, "history", "checkpoint")
    rows = notify.delivery_history(A.notifications_of(event_stream(spark, d)), F.col("ts"))
    drain(store_rows(rows, out, checkpoint, once=True))
    return tables.read_current(spark, out, "notification_id", ["ts", "event_id"], rows.schema).select(
        "notification_id", "event_id", "user_id", "status")


@query("anomaly_scan_stream", SPANS, FOUND, sql="SELECT * FROM found")
def _(spark, d):
    span_log, found, checkpoint = _paths(spark, "spans", "anomalies", "checkpoint")
    drain(scan_spans(A.spans_of(event_files(spark, d)), span_log, found, checkpoint, once=True))
    return spark.read.schema(FINDING).parquet(found).drop("batch_id")
