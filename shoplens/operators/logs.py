"""Structured log lines: parsing, severity and the ingest limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.actions import log_severity, parse_log_time
from shoplens.schemas import LOG_LINE

# Samples older than a week and lines above 256 kB are refused.
MAX_AGE_HOURS = 168
MAX_LINE_BYTES = 256 * 1024


def parse_logs(lines: DataFrame) -> DataFrame:
    """Labels and message of JSON lines; a line that is not JSON keeps its row with empty labels."""
    others = [c for c in lines.columns if c != "line"]
    j = lines.select(*others, F.from_json("line", LOG_LINE, {"mode": "PERMISSIVE"}).alias("j"))
    return j.select(
        *others, F.col("j.level").alias("level"), F.col("j.message").alias("message"),
        F.col("j.logger_name").alias("logger"), F.col("j.thread_name").alias("thread"),
        F.col("j.traceId").alias("trace_id"), F.col("j.spanId").alias("span_id"),
        parse_log_time(F.col("j").getField("@timestamp")).alias("ts"),
        F.col("j.application").alias("application"), F.col("j.stack_trace").alias("exception"),
        log_severity(F.col("j.level")).alias("severity"))


def drop_late_logs(lines: DataFrame, ts: Column, ingested_at: Column, text: Column) -> DataFrame:
    """Lines young and short enough to be stored."""
    young = ts >= ingested_at - F.expr(f"INTERVAL {MAX_AGE_HOURS} HOURS")
    return lines.filter(young & (F.octet_length(text) <= MAX_LINE_BYTES))
