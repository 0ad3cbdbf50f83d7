"""Queries over traces, anomalies and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.functions import actions as FA
from shoplens.functions import spans as FS
from shoplens.operators import dated, filters, logs, reports, topk, traces
from shoplens.plans.registry import ANOMALIES, SPANS, query
from shoplens.schemas import ANOMALY_TYPES, SEVERITIES
from shoplens.session import scratch_path
from shoplens.sources import adapters as A
from shoplens.sources import files

SUMMARY = """
summary AS (SELECT trace_id, arg_min(service_name, (start_us, position)) AS root_service,
    arg_min(operation_name, (start_us, position)) AS root_operation, min(start_us) AS start_us,
    max(start_us + duration_us) - min(start_us) AS duration_us, count(*) AS span_count,
    count(DISTINCT service_name) AS service_count, bool_or(has_error) AS has_error,
    array_to_string(list_sort(list(DISTINCT service_name)), ',') AS services FROM spans GROUP BY trace_id)"""


def _flat(summary):
    return summary.withColumn("services", F.array_join("services", ","))


@query("trace_summary", SPANS, SUMMARY, sql="SELECT * FROM summary")
def _(spark, d):
    return _flat(traces.trace_summary(A.spans(spark, d)))


# The longest trace that the given spans may form; what is read back around a window.
LONGEST_US = 60_000_000


def stored_spans(spark, d):
    """The given spans as a log by the hour, and their schema."""
    path, spans = scratch_path(spark, "spans"), A.spans(spark, d)
    dated.append_spans(spans, path)
    return path, spans.schema


@query("search_traces", SPANS, SUMMARY, sql=f"""
SELECT * FROM summary WHERE services LIKE '%view-service%' AND duration_us BETWEEN 300000 AND 700000
  AND start_us BETWEEN {A.TRACE_EPOCH_US + 100_000_000} AND {A.TRACE_EPOCH_US + 7_300_000_000}
ORDER BY start_us DESC, trace_id LIMIT 20""")
def _(spark, d):
    """Two hours of a span log."""
    log, schema = stored_spans(spark, d)
    found = traces.search_stored_traces(spark, log, schema, A.TRACE_EPOCH_US + 100_000_000, A.TRACE_EPOCH_US + 7_300_000_000,
                                        LONGEST_US, service="view-service", min_us=300_000, max_us=700_000)
    return _flat(found)


@query("list_services", SPANS, sql="SELECT DISTINCT service_name FROM spans")
def _(spark, d):
    return traces.list_services(A.spans(spark, d))


@query("span_services", SPANS, sql="SELECT span_id, service_name FROM spans")
def _(spark, d):
    return traces.span_services(A.spans(spark, d)).select("span_id", "service_name")


@query("span_has_error", SPANS, sql="SELECT span_id, has_error FROM spans")
def _(spark, d):
    return A.spans(spark, d).select("span_id", FS.span_has_error(F.col("tags")).alias("has_error"))


@query("span_is_dlq", SPANS, sql="SELECT span_id, is_dlq FROM spans")
def _(spark, d):
    return A.spans(spark, d).select("span_id", FS.span_is_dlq(F.col("operation_name"), F.col("tags")).alias("is_dlq"))


@query("tag_value", SPANS, sql="SELECT span_id, message FROM spans")
def _(spark, d):
    return A.spans(spark, d).select(
        "span_id", FS.tag_value(F.col("tags"), "error.message", "otel.status_description").alias("message"))


@query("time_units", SPANS, sql="SELECT span_id, duration_us // 1000 AS duration_ms FROM spans")
def _(spark, d):
    return A.spans(spark, d).select("span_id", FA.micros_to_millis(F.col("duration_us")).alias("duration_ms"))


@query("span_parent", SPANS, sql="""
SELECT s.trace_id, s.span_id, p.span_id AS parent_found FROM spans s
LEFT JOIN spans p ON p.trace_id = s.trace_id AND p.span_id = s.parent_id""")
def _(spark, d):
    return traces.span_parent(A.spans(spark, d)).select("trace_id", "span_id", "parent_found")


@query("span_tree", SPANS, """/*recursive*/
linked AS (SELECT s.trace_id, s.span_id, s.operation_name, s.start_us, s.duration_us, p.span_id AS parent,
             printf('%020d.%020d', s.start_us, s.position) AS own
           FROM spans s LEFT JOIN spans p ON p.trace_id = s.trace_id AND p.span_id = s.parent_id),
tree AS (SELECT trace_id, span_id, 0 AS depth, own AS sort_key FROM linked WHERE parent IS NULL
         UNION ALL
         SELECT l.trace_id, l.span_id, t.depth + 1, concat(t.sort_key, '/', l.own)
         FROM tree t JOIN linked l ON l.trace_id = t.trace_id AND l.parent = t.span_id),
bounds AS (SELECT trace_id, min(start_us) AS t0, max(start_us + duration_us) AS t1 FROM spans GROUP BY trace_id)""", sql="""
SELECT trace_id, span_id, operation_name, CAST(depth AS BIGINT) AS depth, sort_key,
  (start_us - t0) / greatest(t1 - t0, 1) AS bar_offset, duration_us / greatest(t1 - t0, 1) AS bar_width
FROM tree JOIN linked USING (trace_id, span_id) JOIN bounds USING (trace_id)""")
def _(spark, d):
    return traces.span_tree(A.spans(spark, d))


FOUND = """
found AS (
  SELECT trace_id, 'SLOW_TRACE' AS type, 'WARNING' AS severity, arg_min(service_name, (start_us, position)) AS service_name,
    arg_min(operation_name, (start_us, position)) AS operation_name, (max(start_us + duration_us) - min(start_us)) // 1000 AS duration_ms,
    500 AS threshold_ms, NULL::VARCHAR AS error_message, count(*) AS span_count
  FROM spans GROUP BY trace_id HAVING (max(start_us + duration_us) - min(start_us)) // 1000 > 500
  UNION ALL
  SELECT trace_id, 'ERROR_SPAN', 'ERROR', service_name, operation_name, duration_us // 1000, NULL, message, NULL FROM spans
  WHERE has_error QUALIFY row_number() OVER (PARTITION BY trace_id ORDER BY position) = 1
  UNION ALL
  SELECT trace_id, 'DLQ_ROUTED', 'CRITICAL', service_name, operation_name, duration_us // 1000, NULL, NULL, NULL FROM spans
  WHERE is_dlq QUALIFY row_number() OVER (PARTITION BY trace_id ORDER BY position) = 1)"""


# A scan in the middle of the given traces, which start a second apart.
SCAN_UNTIL_US = A.TRACE_EPOCH_US + 500_000_000
RECENT = f"""
recent AS (SELECT * FROM spans WHERE trace_id IN (SELECT trace_id FROM spans GROUP BY trace_id
           HAVING min(start_us) BETWEEN {SCAN_UNTIL_US - 300_000_000} AND {SCAN_UNTIL_US}))"""


@query("anomaly_scan", SPANS, ANOMALIES, FOUND, sql="""
SELECT found.* FROM found WHERE NOT EXISTS (
  SELECT 1 FROM stored s WHERE s.trace_id = found.trace_id AND s.type = found.type AND NOT s.is_bookmark)""")
def _(spark, d):
    return traces.anomaly_scan(A.spans(spark, d), A.anomalies(spark, d), until_us=0, minutes=None)


@query("anomaly_scan_five_minutes", SPANS, ANOMALIES, RECENT, FOUND.replace("FROM spans", "FROM recent"), sql="""
SELECT found.* FROM found WHERE NOT EXISTS (
  SELECT 1 FROM stored s WHERE s.trace_id = found.trace_id AND s.type = found.type AND NOT s.is_bookmark)""")
def _(spark, d):
    log, schema = stored_spans(spark, d)
    return traces.scan_stored_traces(spark, log, schema, A.anomalies(spark, d), SCAN_UNTIL_US, longest_us=LONGEST_US)


@query("new_anomalies_only", SPANS, ANOMALIES, """
slow AS (SELECT DISTINCT trace_id, 'SLOW_TRACE' AS type FROM spans)""", sql="""
SELECT trace_id, type FROM slow WHERE trace_id NOT IN (SELECT trace_id FROM stored WHERE type = 'SLOW_TRACE' AND NOT is_bookmark)""")
def _(spark, d):
    every = A.spans(spark, d).select("trace_id", F.lit("SLOW_TRACE").alias("type")).distinct()
    return traces.new_anomalies_only(every, A.anomalies(spark, d))


@query("exists_count", ANOMALIES, sql="""
SELECT count(*) FILTER (type = 'ERROR_SPAN' AND NOT is_bookmark) AS n,
  count(*) FILTER (type = 'ERROR_SPAN' AND NOT is_bookmark) > 0 AS found FROM stored""")
def _(spark, d):
    return reports.exists_count(A.anomalies(spark, d), (F.col("type") == "ERROR_SPAN") & ~F.col("is_bookmark"))


@query("search_anomalies", ANOMALIES, sql="""
SELECT trace_id, event_id, type, service_name, detected_at FROM stored
WHERE NOT is_bookmark AND type = 'SLOW_TRACE' AND service_name = 'click-service'
  AND detected_at >= TIMESTAMP '2024-01-03 00:00:00' AND detected_at <= TIMESTAMP '2024-01-20 00:00:00'""")
def _(spark, d):
    return filters.search_anomalies(
        A.anomalies(spark, d), type_="SLOW_TRACE", service="click-service",
        since=F.to_timestamp(F.lit("2024-01-03 00:00:00")), until=F.to_timestamp(F.lit("2024-01-20 00:00:00"))).select(
        "trace_id", "event_id", "type", "service_name", "detected_at")


@query("page", ANOMALIES, sql="""
SELECT trace_id, event_id, type, detected_at FROM stored WHERE NOT is_bookmark
ORDER BY detected_at DESC, event_id LIMIT 20 OFFSET 40""")
def _(spark, d):
    found = filters.search_anomalies(A.anomalies(spark, d)).select("trace_id", "event_id", "type", "detected_at")
    return topk.page(found, [F.desc("detected_at"), F.asc("event_id")], 2, 20)


@query("list_bookmarks", ANOMALIES, sql="""
SELECT trace_id, event_id, note, created_at FROM stored WHERE is_bookmark ORDER BY created_at DESC, trace_id LIMIT 100""")
def _(spark, d):
    return filters.list_bookmarks(A.anomalies(spark, d)).select("trace_id", "event_id", "note", "created_at")


@query("enum_or_default", ANOMALIES, sql=f"""
SELECT event_id, CASE WHEN type IN {tuple(ANOMALY_TYPES)} THEN type ELSE 'SLOW_TRACE' END AS type,
  CASE WHEN severity IN {tuple(SEVERITIES)} THEN severity ELSE 'WARNING' END AS severity FROM stored""")
def _(spark, d):
    return A.anomalies(spark, d).select(
        "event_id", FA.enum_or_default(F.col("type"), ANOMALY_TYPES, "SLOW_TRACE").alias("type"),
        FA.enum_or_default(F.col("severity"), SEVERITIES, "WARNING").alias("severity"))


@query("read_traces", SPANS,
       sql="SELECT trace_id, span_id, parent_id, operation_name, service_name, start_us, duration_us, has_error FROM spans")
def _(spark, d):
    """Span rows written as nested trace records and read back."""
    s = A.spans(spark, d)
    text = F.col("span_id").cast("string")
    parent = F.when(F.col("parent_id").isNotNull(), F.array(F.struct(
        F.lit("CHILD_OF").alias("refType"), F.col("trace_id").alias("traceID"),
        F.col("parent_id").cast("string").alias("spanID"))))
    record = F.struct(
        F.col("trace_id").alias("traceID"), text.alias("spanID"), F.col("operation_name").alias("operationName"),
        parent.alias("references"), F.col("start_us").alias("startTime"), F.col("duration_us").alias("duration"),
        F.col("tags"), F.col("process_id").alias("processID"))
    path = scratch_path(spark, "traces")
    s.groupBy(F.col("trace_id").alias("traceID")).agg(
        F.sort_array(F.collect_list(F.struct("span_id", record.alias("r")))).alias("rows"),
        F.first("processes").alias("processes")).select(
        "traceID", F.transform("rows", lambda r: r["r"]).alias("spans"), "processes").write.json(path)
    flat = traces.span_services(traces.explode_traces(files.read_traces(spark, path)))
    return flat.select(
        "trace_id", F.col("span_id").cast("bigint").alias("span_id"), F.col("parent_id").cast("bigint").alias("parent_id"),
        "operation_name", "service_name", "start_us", "duration_us", FS.span_has_error(F.col("tags")).alias("has_error"))


# --- logs

PARSED = """
parsed AS (SELECT event_id, user_id <> 13 AS ok,
    CASE WHEN user_id <> 13 THEN CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END END AS level,
    CASE WHEN user_id <> 13 THEN concat('user ', user_id, ' did ', event_type) END AS message,
    CASE WHEN user_id <> 13 THEN concat('shop.', event_type) END AS logger,
    CASE WHEN user_id <> 13 THEN concat('worker-', event_id % 4) END AS thread,
    CASE WHEN user_id <> 13 THEN concat('T', event_id) END AS trace_id,
    CASE WHEN user_id <> 13 THEN concat('S', event_id) END AS span_id,
    CASE WHEN user_id <> 13 THEN CASE WHEN event_id % 3 = 2 THEN date_trunc('second', ts) ELSE make_timestamp(epoch_us(ts) // 1000 * 1000) END END AS ts,
    CASE WHEN user_id <> 13 THEN concat(event_type, '-app') END AS application,
    CASE WHEN user_id <> 13 AND event_type = 'error' THEN 'at shop.Main' END AS exception,
    CASE WHEN user_id <> 13 THEN CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warning' END END AS severity, ts AS ingested_at
  FROM events)"""


@query("parse_logs", PARSED,
       sql="SELECT event_id, level, message, logger, thread, trace_id, span_id, ts, application, exception, severity FROM parsed")
def _(spark, d):
    return logs.parse_logs(A.log_lines(spark, d)).drop("ingested_at")


@query("parse_log_time", PARSED, sql="SELECT event_id, ts FROM parsed WHERE ok")
def _(spark, d):
    stamp = F.get_json_object("line", "$['@timestamp']")
    lines = A.log_lines(spark, d).select("event_id", FA.parse_log_time(stamp).alias("ts"))
    return lines.filter(F.col("ts").isNotNull())


@query("log_severity", PARSED, sql="SELECT severity, count(*) AS n FROM parsed GROUP BY severity")
def _(spark, d):
    return logs.parse_logs(A.log_lines(spark, d)).groupBy("severity").agg(F.count("*").alias("n"))


@query("search_logs", PARSED, sql="SELECT event_id, message FROM parsed WHERE level = 'ERROR' AND application = 'error-app'")
def _(spark, d):
    return filters.search_logs(logs.parse_logs(A.log_lines(spark, d)), level="ERROR", application="error-app").select(
        "event_id", "message")


@query("drop_late_logs", PARSED, sql="""
SELECT event_id FROM parsed WHERE ok AND ts >= ingested_at + to_days(CAST(event_id % 14 AS INTEGER)) - INTERVAL 168 HOUR""")
def _(spark, d):
    lines = A.log_lines(spark, d)
    late = F.col("ingested_at") + F.make_dt_interval((F.col("event_id") % 14).cast("int"))
    parsed = lines.withColumn("ts", FA.parse_log_time(F.get_json_object("line", "$['@timestamp']")))
    return logs.drop_late_logs(parsed, F.col("ts"), late, F.col("line")).select("event_id")
