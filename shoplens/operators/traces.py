"""Traces: summaries, parent links, the span tree and the anomaly scan.

Span frames are flat, one row per span: (trace_id, span_id, parent_id, operation_name, process_id, processes,
start_us, duration_us, tags, position). `position` is a span's place in its trace's list, which decides between spans
that start together; where a frame lacks it, the span's id does. Ids may be of any type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions.actions import micros_to_millis
from shoplens.functions.spans import service_of, span_has_error, span_is_dlq, tag_value
from shoplens.operators.dated import spans_between, traces_between
from shoplens.session import durable

# What counts as slow, how far back a scan looks, and how many traces a search returns.
SLOW_TRACE_MS = 500
SCAN_MINUTES = 5
SEARCH_LIMIT = 20
# No trace may last longer; what is read back around a window of time.
LONGEST_TRACE_US = 3_600_000_000


def span_services(spans: DataFrame) -> DataFrame:
    return spans.withColumn("service_name", service_of(F.col("processes"), F.col("process_id")))


def list_services(spans: DataFrame) -> DataFrame:
    return span_services(spans).select("service_name").distinct()


def explode_traces(traces: DataFrame) -> DataFrame:
    """Flat span rows of nested trace records."""
    s = traces.select(F.col("traceID").alias("trace_id"), "processes", F.posexplode("spans").alias("position", "s"))
    parent = F.try_element_at(F.filter("s.references", lambda r: r["refType"] == "CHILD_OF"), F.lit(1))["spanID"]
    return s.select(
        "trace_id", F.col("s.spanID").alias("span_id"), parent.alias("parent_id"),
        F.col("s.operationName").alias("operation_name"), F.col("s.processID").alias("process_id"), "processes",
        F.col("s.startTime").alias("start_us"), F.col("s.duration").alias("duration_us"),
        F.col("s.tags").alias("tags"), "position")


def _place(spans: DataFrame) -> Column:
    return F.col("position" if "position" in spans.columns else "span_id")


def trace_summary(spans: DataFrame) -> DataFrame:
    """Per trace: root (earliest span, the first in the list of equals), duration, span and service counts, error flag, start."""
    known = span_services(spans).withColumn("has_error", span_has_error(F.col("tags")))
    root = F.min_by(F.struct("service_name", "operation_name"), F.struct(F.col("start_us"), _place(spans)))
    per_trace = known.groupBy("trace_id").agg(
        root.alias("root"), F.min("start_us").alias("start_us"),
        (F.max(F.col("start_us") + F.col("duration_us")) - F.min("start_us")).alias("duration_us"),
        F.count("*").alias("span_count"), F.bool_or("has_error").alias("has_error"),
        F.array_sort(F.collect_set("service_name")).alias("services"))
    return per_trace.select(
        "trace_id", F.col("root.service_name").alias("root_service"), F.col("root.operation_name").alias("root_operation"),
        "start_us", "duration_us", "span_count", F.size("services").alias("service_count"), "has_error", "services")


def search_traces(summaries: DataFrame, *, service: str | None = None, min_us: int | None = None,
                  max_us: int | None = None, start_us: int | None = None, end_us: int | None = None,
                  limit: int = SEARCH_LIMIT) -> DataFrame:
    found = summaries
    if service is not None:
        found = found.filter(F.array_contains("services", service))
    if min_us is not None:
        found = found.filter(F.col("duration_us") >= min_us)
    if max_us is not None:
        found = found.filter(F.col("duration_us") <= max_us)
    if start_us is not None:
        found = found.filter(F.col("start_us") >= start_us)
    if end_us is not None:
        found = found.filter(F.col("start_us") <= end_us)
    return found.orderBy(F.desc("start_us"), F.asc("trace_id")).limit(limit)


def stored_traces(spark: SparkSession, log: str, schema: T.StructType, since_us: int, until_us: int,
                  longest_us: int = LONGEST_TRACE_US) -> DataFrame:
    """All spans of the traces that start in [since_us, until_us], from the hours of a span log that can hold them.

    A trace that lasts longer than `longest_us` is an error.
    """
    spans = spans_between(spark, log, schema, since_us, until_us, longest_us)
    return spans.join(traces_between(spans, since_us, until_us, longest_us), "trace_id", "left_semi")


def search_stored_traces(spark: SparkSession, log: str, schema: T.StructType, since_us: int, until_us: int,
                         longest_us: int = LONGEST_TRACE_US, **wanted) -> DataFrame:
    """As `search_traces` over a window of time, which decides what is read before anything is summarised."""
    return search_traces(trace_summary(stored_traces(spark, log, schema, since_us, until_us, longest_us)), **wanted)


def scan_stored_traces(spark: SparkSession, log: str, schema: T.StructType, stored: DataFrame, until_us: int,
                       minutes: int = SCAN_MINUTES, longest_us: int = LONGEST_TRACE_US, slow_ms: int = SLOW_TRACE_MS) -> DataFrame:
    """As `anomaly_scan` over a span log; only the hours that the window and `longest_us` ask for are read."""
    spans = stored_traces(spark, log, schema, until_us - minutes * 60_000_000, until_us, longest_us)
    return new_anomalies_only(find_anomalies(spans, slow_ms), stored)


def span_parent(spans: DataFrame) -> DataFrame:
    """Spans with `parent_found`: the parent if it is in the same trace, else null (the span is a root)."""
    there = spans.select("trace_id", F.col("span_id").alias("parent_id"), F.col("span_id").alias("parent_found"))
    return spans.join(there, ["trace_id", "parent_id"], "left")


def span_tree(spans: DataFrame) -> DataFrame:
    """Depth of each span and `sort_key`, by which (trace_id, sort_key) is the pre-order, siblings by start.

    Every span first knows the path from its parent to itself; each round doubles the known part by joining a span
    with the span its path starts under, so a tree of depth d needs log2(d) rounds. Long traces stay distributed.
    Spans that no root leads to (their parents form a cycle) are left out; a cycle shows as a path that meets itself.
    """
    place = _place(spans)
    if "position" in spans.columns or dict(spans.dtypes)["span_id"] != "string":
        place = F.format_string("%020d", place.cast("long"))
    own = F.concat(F.format_string("%020d.", F.col("start_us")), place)
    linked = span_parent(spans).select(
        "trace_id", "span_id", F.col("parent_found").alias("above"), F.array(own).alias("path"))
    paths = durable(linked)
    while not paths.filter(F.col("above").isNotNull()).isEmpty():
        upper = paths.select("trace_id", F.col("span_id").alias("above"), F.col("above").alias("_above"),
                             F.col("path").alias("_path"))
        paths = durable(
            paths.join(upper, ["trace_id", "above"], "left")
            .filter(F.col("above").isNull() | F.col("_path").isNotNull())
            .select("trace_id", "span_id", F.col("_above").alias("above"),
                    F.concat(F.coalesce("_path", F.array().cast("array<string>")), "path").alias("path"))
            .filter(F.size(F.array_distinct("path")) == F.size("path")))
    bounds = spans.groupBy("trace_id").agg(
        F.min("start_us").alias("t0"), F.max(F.col("start_us") + F.col("duration_us")).alias("t1"))
    length = F.greatest(F.col("t1") - F.col("t0"), F.lit(1))
    return (spans.select("trace_id", "span_id", "operation_name", "start_us", "duration_us")
            .join(paths.select("trace_id", "span_id", "path"), ["trace_id", "span_id"]).join(bounds, "trace_id")
            .select("trace_id", "span_id", "operation_name", (F.size("path") - 1).alias("depth"),
                    F.array_join("path", "/").alias("sort_key"),
                    ((F.col("start_us") - F.col("t0")) / length).alias("bar_offset"),
                    (F.col("duration_us") / length).alias("bar_width")))


def find_anomalies(spans: DataFrame, slow_ms: int = SLOW_TRACE_MS) -> DataFrame:
    """At most one finding per trace and type, from one aggregation over the spans."""
    s = span_services(spans).select(
        "trace_id", "service_name", "operation_name", "start_us", "duration_us", _place(spans).alias("place"),
        span_has_error(F.col("tags")).alias("is_error"),
        span_is_dlq(F.col("operation_name"), F.col("tags")).alias("is_dlq"),
        tag_value(F.col("tags"), "error.message", "otel.status_description").alias("message"))
    told = F.struct("service_name", "operation_name", "duration_us", "message")
    ms = micros_to_millis

    def first_of(flag: str) -> Column:
        return F.min_by(F.when(F.col(flag), told), F.when(F.col(flag), F.col("place")))

    t = s.groupBy("trace_id").agg(
        F.min_by(told, F.struct("start_us", "place")).alias("root"), first_of("is_error").alias("error"),
        first_of("is_dlq").alias("dlq"), F.count("*").alias("spans"),
        (F.max(F.col("start_us") + F.col("duration_us")) - F.min("start_us")).alias("total_us"))

    def finding(type_, severity, at, duration, threshold=None, message=None, count=None):
        return F.struct(
            F.lit(type_).alias("type"), F.lit(severity).alias("severity"), F.col(f"{at}.service_name").alias("service_name"),
            F.col(f"{at}.operation_name").alias("operation_name"), duration.alias("duration_ms"),
            F.lit(threshold).cast("bigint").alias("threshold_ms"),
            (F.lit(None).cast("string") if message is None else message).alias("error_message"),
            (F.lit(None).cast("bigint") if count is None else count).alias("span_count"))

    total = ms(F.col("total_us"))
    found = F.array(
        F.when(total > slow_ms, finding("SLOW_TRACE", "WARNING", "root", total, slow_ms, count=F.col("spans"))),
        F.when(F.col("error").isNotNull(), finding("ERROR_SPAN", "ERROR", "error", ms(F.col("error.duration_us")),
                                                   message=F.col("error.message"))),
        F.when(F.col("dlq").isNotNull(), finding("DLQ_ROUTED", "CRITICAL", "dlq", ms(F.col("dlq.duration_us")))))
    return t.select("trace_id", F.explode(F.filter(found, lambda a: a.isNotNull())).alias("a")).select("trace_id", "a.*")


def new_anomalies_only(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Findings without a stored finding (bookmarks do not count) of the same trace and type."""
    known = stored.filter(~F.col("is_bookmark")).select("trace_id", "type")
    return found.join(known, ["trace_id", "type"], "left_anti")


def anomaly_scan(spans: DataFrame, stored: DataFrame, until_us: int, minutes: int | None = SCAN_MINUTES,
                 slow_ms: int = SLOW_TRACE_MS) -> DataFrame:
    """New findings in the traces that start in the last `minutes` up to `until_us` (None: in all traces)."""
    if minutes is not None:
        since = until_us - minutes * 60_000_000
        starts = spans.groupBy("trace_id").agg(F.min("start_us").alias("t0")).filter(
            (F.col("t0") >= since) & (F.col("t0") <= until_us))
        spans = spans.join(starts.select("trace_id"), "trace_id", "left_semi")
    return new_anomalies_only(find_anomalies(spans, slow_ms), stored)
