"""Counts and shares for dashboards. All are hash aggregations with map-side combine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def events_by_user(actions: DataFrame) -> DataFrame:
    """Actions of a user together and in arrival order; a user with very many is laid over neighbouring partitions."""
    order = ["user_id", "ts", "event_id"]
    return actions.repartitionByRange(*order).sortWithinPartitions(*order)


def exists_count(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.count_if(condition).alias("n")).withColumn("found", F.col("n") > 0)


def bulk_outcome(rows: DataFrame) -> DataFrame:
    """Per batch, stored and failed documents and whether any failed: `rows(batch_id, ok)`."""
    return rows.groupBy("batch_id").agg(
        F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed")).withColumn(
        "batch_failed", F.col("failed") > 0)


def processing_funnel(rows: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """One row with the number of rows that reach each stage."""
    return rows.agg(*[F.count_if(condition).alias(stage) for stage, condition in stages.items()])


def batch_size_percentiles(sizes: DataFrame, column: str = "size") -> DataFrame:
    """p50, p90, p99: the smallest size that so large a share of the batches doesn't exceed, exactly.

    Batches are counted by size first, so only one row per distinct size meets in the running sum.
    """
    counts = sizes.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    upto = counts.select(F.col(column).alias("size"), F.sum("n").over(Window.orderBy(column)).alias("upto"))
    total = counts.agg(F.sum("n")).scalar()
    return upto.agg(*[
        F.min(F.when(F.col("upto") >= F.ceil(F.lit(p) * total), F.col("size"))).alias(f"p{round(p * 100)}")
        for p in (0.5, 0.9, 0.99)])


def channel_counts(deliveries: DataFrame) -> DataFrame:
    return deliveries.groupBy("channel").agg(F.count("*").alias("n"))


def strategy_mix(recommendations: DataFrame) -> DataFrame:
    return recommendations.groupBy("strategy").agg(
        F.count("*").alias("products"), F.count_distinct("user_id").alias("users"))


def request_stats(requests: DataFrame) -> DataFrame:
    """Totals, errors, and the mean latency of successful requests (0 without any): `requests(ok, latency_ms)`."""
    return requests.agg(
        F.count("*").alias("total_requests"), F.count_if(~F.col("ok")).alias("total_errors"),
        F.coalesce(F.avg(F.when(F.col("ok"), F.col("latency_ms"))), F.lit(0.0)).alias("avg_latency_ms"))


def dominant_category(actions: DataFrame) -> DataFrame:
    """The category each user clicked most; ties go to the first name."""
    counts = actions.filter((F.col("action_type") == "CLICK") & F.col("category").isNotNull()).groupBy(
        "user_id", "category").agg(F.count("*").alias("n"))
    return counts.groupBy("user_id").agg(
        F.min_by("category", F.struct(-F.col("n"), F.col("category"))).alias("dominant"))


def category_hit_rate(recommendations: DataFrame, actions: DataFrame, target: float = 0.7) -> DataFrame:
    """Per user, the share of recommended products in the category they click most."""
    return (recommendations.join(dominant_category(actions), "user_id").groupBy("user_id")
            .agg(F.avg((F.col("category") == F.col("dominant")).cast("int")).alias("hit_rate"))
            .withColumn("on_target", F.col("hit_rate") >= target))


def catalog_counts(goods: DataFrame) -> DataFrame:
    return goods.groupBy("category").agg(F.count("*").alias("products"))


def detection_counts(attempts: DataFrame, capped: DataFrame, admitted: DataFrame) -> DataFrame:
    """Per type: attempts, blocked by the daily cap, blocked as duplicate, sent."""
    rows = (attempts.select("notification_type", F.lit("a").alias("stage"))
            .unionByName(capped.select("notification_type", F.lit("c").alias("stage")))
            .unionByName(admitted.select("notification_type", F.lit("s").alias("stage"))))
    n = {s: F.count_if(F.col("stage") == s) for s in "acs"}
    return rows.groupBy("notification_type").agg(
        n["a"].alias("attempts"), (n["a"] - n["c"]).alias("daily_blocked"),
        (n["c"] - n["s"]).alias("duplicate_blocked"), n["s"].alias("sent"))


def events_per_second(snapshots: DataFrame, every_sec: int = 3, keep: int = 20) -> DataFrame:
    """Rounded rate between consecutive snapshots of a counter, newest `keep` per series: (series, ts, count)."""
    order = Window.partitionBy("series").orderBy("ts")
    rate = F.floor((F.col("count") - F.lag("count").over(order)) / every_sec + 0.5)
    rated = snapshots.withColumn("rate", F.coalesce(rate, F.lit(0)).cast("bigint"))
    newest = Window.partitionBy("series").orderBy(F.desc("ts"))
    return rated.withColumn("age", F.row_number().over(newest)).filter(F.col("age") <= keep).drop("age")
