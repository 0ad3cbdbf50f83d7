"""Queries that write tables or files and read them back."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators import dated, notify, popularity, snapshots, tables
from shoplens.operators.dated import KeyedTable
from shoplens.plans.metric_queries import SAMPLES
from shoplens.plans.registry import ACTIONS, AS_OF_SQL, INVENTORY, NOTIFICATIONS, PRODUCTS, VECTORS, popular_sql, query
from shoplens.schemas import ACTION_TYPES
from shoplens.session import durable, scratch_path
from shoplens.sources import adapters as A
from shoplens.sources import files, streams

STORED = """
shared AS (SELECT CASE WHEN action_type <> 'SIGNUP' THEN concat('T', event_id // 2) END AS trace_id, event_id, user_id, product_id,
             action_type, ts, CASE WHEN action_type IN ('VIEW', 'CLICK', 'SIGNUP') THEN 0 ELSE 1 END AS batch FROM ua)"""


def shared_traces(spark, d):
    """Actions of which two consecutive ones share a trace id; sign-ups have none."""
    return A.user_actions(spark, d).select(
        F.when(F.col("action_type") != "SIGNUP", F.concat(F.lit("T"), F.call_function("div", F.col("event_id"), F.lit(2))))
         .alias("trace_id"), "event_id", "user_id", "product_id", "action_type", "ts")


@query("upsert_behavior", ACTIONS, STORED, sql="""
SELECT trace_id, event_id, user_id, product_id, action_type FROM shared
QUALIFY trace_id IS NULL OR row_number() OVER (PARTITION BY trace_id ORDER BY batch DESC, ts DESC, event_id DESC) = 1""")
def _(spark, d):
    """The whole of a table that two batches were merged into; rows of both may share a key on different days."""
    rows, path = shared_traces(spark, d), scratch_path(spark, "behavior")
    table = KeyedTable(path, rows.schema, "trace_id", "ts", ("ts", "event_id"), buckets=2)
    first = F.col("action_type").isin("VIEW", "CLICK", "SIGNUP")
    table.merge(rows.filter(first), 0)
    table.merge(rows.filter(~first), 1)
    table.merge(rows.filter(~first), 1)  # delivered again: no growth
    return table.read(spark).drop("ts")


@query("save_history", NOTIFICATIONS, sql="""
SELECT notification_id, event_id, user_id, notification_type,
  CASE WHEN list_has_any(channels, ['FAX']) THEN 'FAILED' ELSE 'SENT' END AS status FROM notes
QUALIFY row_number() OVER (PARTITION BY notification_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, d):
    rows = notify.delivery_history(A.notifications(spark, d), F.col("ts"))
    table = KeyedTable(scratch_path(spark, "history"), rows.schema, "notification_id", "ts", ("ts", "event_id"), buckets=2)
    table.merge(rows, 0)
    return table.read(spark).select("notification_id", "event_id", "user_id", "notification_type", "status")


@query("dead_letter", ACTIONS, sql=f"""
SELECT event_id, action_type, action_type IN {tuple(ACTION_TYPES)} AS stored,
  CASE WHEN action_type IN {tuple(ACTION_TYPES)} THEN '' ELSE 'unknown action' END AS reasons FROM ua""")
def _(spark, d):
    good, bad = tables.split_rejects(A.user_actions(spark, d), tables.action_rules(ACTION_TYPES))
    return good.select("event_id", "action_type", F.lit(True).alias("stored"), F.lit("").alias("reasons")).unionByName(
        bad.select("event_id", "action_type", F.lit(False).alias("stored"), F.array_join("reject_reasons", ",").alias("reasons")))


@query("replay_dead_letters", ACTIONS, sql="SELECT event_id, action_type FROM ua WHERE action_type <> 'ERROR'")
def _(spark, d):
    """Rejects are kept, then judged again by rules that know one more action type."""
    rows, path = A.user_actions(spark, d), scratch_path(spark, "replay")
    good, bad = tables.split_rejects(rows, tables.action_rules(ACTION_TYPES))
    rejects = durable(bad.drop("reject_reasons"))
    again, _still_bad = tables.split_rejects(rejects, tables.action_rules([*ACTION_TYPES, "SIGNUP"]))
    tables.write_batch(good, path, 0)
    tables.write_batch(again, path, 1)
    return tables.read_current(spark, path, "trace_id", ["ts", "event_id"], rows.schema).select("event_id", "action_type")


@query("failed_events_file", ACTIONS, sql=f"""
SELECT CAST(ts AS DATE) AS day, epoch_us(ts) AS ts_us, trace_id, CAST(user_id AS VARCHAR) AS user_id,
  CAST(product_id AS VARCHAR) AS product_id, action_type FROM ua WHERE action_type NOT IN {tuple(ACTION_TYPES)}""")
def _(spark, d):
    _good, bad = tables.split_rejects(A.user_actions(spark, d), tables.action_rules(ACTION_TYPES))
    path = scratch_path(spark, "failed")
    files.write_failed_events(bad, path)
    return files.read_failed_events(spark, path).withColumn("ts_us", F.unix_micros("ts")).drop("ts")


@query("load_catalog_ndjson", PRODUCTS, VECTORS, sql="""
SELECT CAST(product_id AS VARCHAR) AS product_id, product_name, category, brand, CAST(price AS DOUBLE) AS price, stock, description,
  coalesce(len(product_vector), 0) AS dims, created_at_ms FROM goods LEFT JOIN vectors USING (product_id)""")
def _(spark, d):
    c = F.col
    docs = A.catalog(spark, d).select(
        c("product_id").cast("string").alias("productId"), c("product_name").alias("productName"), "category", "brand",
        "price", "stock", "description", c("product_vector").alias("productVector"), c("created_at_ms").alias("createdAt"),
        c("created_at_ms").alias("updatedAt"))
    path = scratch_path(spark, "catalog")
    files.write_catalog_ndjson(docs, path)
    return files.load_catalog_ndjson(spark, path).select(
        c("productId").alias("product_id"), c("productName").alias("product_name"), "category", "brand", "price", "stock",
        "description", F.coalesce(F.size("productVector"), F.lit(0)).alias("dims"), c("createdAt").alias("created_at_ms"))


@query("publish_notifications", NOTIFICATIONS, sql="""
SELECT CAST(user_id AS VARCHAR) AS key, notification_id, event_id, notification_type, array_to_string(channels, ',') AS channels FROM notes""")
def _(spark, d):
    rows, path = A.notifications(spark, d), scratch_path(spark, "published")
    streams.as_records(rows, "user_id").write.json(path)
    back = spark.read.schema("key string, value string").json(path)
    body = F.from_json("value", rows.schema)
    return back.select("key", body.alias("b")).select(
        "key", "b.notification_id", "b.event_id", "b.notification_type", F.array_join("b.channels", ",").alias("channels"))


def _kept_sql(topic, table, ts, days, where="true"):
    return f"SELECT '{topic}' AS topic, count(*) AS kept FROM {table} WHERE {where} AND {ts} >= {AS_OF_SQL} - INTERVAL {days} DAY"


@query("retention", ACTIONS, INVENTORY, NOTIFICATIONS, SAMPLES, sql=" UNION ALL ".join([
    _kept_sql("user_actions", "ua", "ts", 7), _kept_sql("inventory_events", "inv", "ts", 7), _kept_sql("notifications", "notes", "ts", 1),
    _kept_sql("dead_letters", "ua", "ts", 30, f"action_type NOT IN {tuple(ACTION_TYPES)}"), _kept_sql("logs", "events", "ts", 7),
    _kept_sql("metrics", "samples", "make_timestamp(at_sec * 1000000)", 15)]))
def _(spark, d):
    """Six topics as logs by day; days beyond a topic's period are removed, and what is left of them is read back."""
    actions = A.user_actions(spark, d)
    topics = {
        "user_actions": actions, "inventory_events": A.inventory_events(spark, d), "notifications": A.notifications(spark, d),
        "dead_letters": tables.split_rejects(actions, tables.action_rules(ACTION_TYPES))[1],
        "logs": A.log_lines(spark, d).withColumn("ts", F.col("ingested_at")), "metrics": A.metric_samples(spark, d)}
    counts = []
    for topic, rows in topics.items():
        path, first = scratch_path(spark, topic), A.AS_OF_TIME - dt.timedelta(days=tables.RETENTION_DAYS[topic])
        dated.append_days(rows, path, "ts")
        dated.drop_before(spark, path, first.date())
        left = dated.read_days(spark, path, T.StructType([rows.schema["ts"]]), "ts", since=first)
        counts.append(left.agg(F.count("*").alias("kept")).select(F.lit(topic).alias("topic"), "kept"))
    return reduce(DataFrame.unionByName, counts)


@query("apply_changes", """
log AS (SELECT user_id AS id, event_id AS seq, CASE event_type WHEN 'click' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'note' END AS op,
          concat('n', event_id) AS note, value FROM events WHERE event_type IN ('click', 'error', 'signup')
        UNION ALL SELECT user_id, -1, 'insert', concat('n', max(event_id)), arg_max(value, event_id) FROM events
        WHERE event_type = 'purchase' GROUP BY user_id),
base AS (SELECT id, seq, op, note, value FROM log WHERE op <> 'note' QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1),
notes AS (SELECT id, max(seq) AS seq, arg_max(note, seq) AS note FROM log WHERE op = 'note' GROUP BY id)""", sql="""
SELECT base.id, CASE WHEN notes.seq > base.seq THEN notes.note ELSE base.note END AS note, value
FROM base LEFT JOIN notes USING (id) WHERE op = 'insert'""")
def _(spark, d):
    e = A.table(spark, d, "events").select(
        F.col("user_id").alias("id"), F.col("event_id").alias("seq"), "event_type",
        F.concat(F.lit("n"), "event_id").alias("note"), "value")
    stored = e.filter("event_type = 'purchase'").groupBy("id").agg(
        F.max_by(F.struct("note", "value"), "seq").alias("r")).select("id", "r.note", "r.value")
    op = F.when(F.col("event_type") == "click", "insert").when(F.col("event_type") == "error", "delete").otherwise("note")
    changes = e.filter(F.col("event_type").isin("click", "error", "signup")).withColumn("op", op).drop("event_type")
    return tables.apply_changes(stored, changes, "id")


@query("popular_snapshot", ACTIONS, PRODUCTS, popular_sql(100), sql="SELECT product_id, product_name, rank FROM popular")
def _(spark, d):
    """Three callers: the second finds the first one's list expired, the third finds the second one's alive."""
    path = scratch_path(spark, "popular")
    ranked = popularity.popular_products(A.user_actions(spark, d), A.products(spark, d), A.as_of())
    for minutes in (60, 5, 0):
        shown = snapshots.refresh_snapshot(spark, path, ranked.schema, lambda: ranked, A.AS_OF_TIME - dt.timedelta(minutes=minutes))
    return shown.select("product_id", "product_name", "rank")
