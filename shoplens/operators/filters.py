"""Projections and predicates on actions, products, anomalies, traces and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.vectors import has_vector


def project_behavior(actions: DataFrame) -> DataFrame:
    """Stored form of an action: empty text for a missing trace id, milliseconds for the time."""
    return actions.select(
        F.coalesce("trace_id", F.lit("")).alias("trace_id"), "user_id", "product_id", "action_type",
        F.unix_millis("ts").alias("timestamp_ms"))


def valid_products(goods: DataFrame) -> DataFrame:
    filled = [F.trim(F.col(c).cast("string")) != "" for c in ("product_id", "product_name", "category")]
    return goods.filter(filled[0] & filled[1] & filled[2] & (F.col("price") >= 0))


def with_usable_vector(goods: DataFrame, dims: int) -> DataFrame:
    return goods.filter(has_vector(F.col("product_vector"), dims))


def filter_actions(actions: DataFrame, action_types: list[str], category: str | None = None) -> DataFrame:
    kept = actions.filter(F.col("action_type").isin(action_types))
    return kept if category is None else kept.filter(F.col("category") == category)


def recent_window(df: DataFrame, as_of: Column, days: int, ts: str = "ts") -> DataFrame:
    """The last `days` days up to `as_of`, both ends included."""
    return df.filter((F.col(ts) >= as_of - F.expr(f"INTERVAL {days} DAYS")) & (F.col(ts) <= as_of))


def in_stock(goods: DataFrame) -> DataFrame:
    return goods.filter(F.col("stock") > 0)


def source_projection(goods: DataFrame) -> DataFrame:
    return goods.select("product_id", "product_name", "category", "price")


def get_products(goods: DataFrame, ids: DataFrame) -> DataFrame:
    """The products asked for; unknown ids are left out."""
    return goods.join(ids.select("product_id").distinct(), "product_id", "left_semi")


def exclude_viewed(candidates: DataFrame, viewed: DataFrame) -> DataFrame:
    return candidates.join(viewed.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")


def search_anomalies(anomalies: DataFrame, *, type_: str | None = None, service: str | None = None,
                     since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Findings (no bookmarks) that match every given filter; page them with `topk.page`."""
    found = anomalies.filter(~F.col("is_bookmark"))
    if type_ is not None:
        found = found.filter(F.col("type") == type_)
    if service is not None:
        found = found.filter(F.col("service_name") == service)
    if since is not None:
        found = found.filter(F.col("detected_at") >= since)
    if until is not None:
        found = found.filter(F.col("detected_at") <= until)
    return found


def list_bookmarks(anomalies: DataFrame, limit: int = 100) -> DataFrame:
    return anomalies.filter("is_bookmark").orderBy(F.desc("created_at"), F.asc("trace_id")).limit(limit)


def search_logs(logs: DataFrame, **labels: str) -> DataFrame:
    """Parsed log rows whose labels (level, trace_id, application, ...) have the given values."""
    for label, value in labels.items():
        logs = logs.filter(F.col(label) == value)
    return logs
