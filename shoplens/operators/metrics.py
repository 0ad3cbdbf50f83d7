"""Metric time series in long form (metric, label, le, ts, value).

Windows run per series, whose length is the number of scrapes, not of events. Rates use the plain increase between
samples without extrapolation to the window's ends.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = ["metric", "label", "le"]


def counter_increase(samples: DataFrame, window_sec: int) -> DataFrame:
    """Increase over the trailing `window_sec`, aware of counter restarts."""
    order = Window.partitionBy(*SERIES).orderBy("ts")
    before = F.lag("value").over(order)
    step = F.when(before.isNull(), 0.0).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    trailing = Window.partitionBy(*SERIES).orderBy(F.unix_seconds("ts")).rangeBetween(-window_sec + 1, 0)
    return samples.withColumn("step", step).select(*SERIES, "ts", F.sum("step").over(trailing).alias("increase"))


def counter_rate(samples: DataFrame, window_sec: int) -> DataFrame:
    return counter_increase(samples, window_sec).select(
        *SERIES, "ts", (F.col("increase") / window_sec).alias("rate"))


def sum_by_label(samples: DataFrame, labels: list[str], value: str = "value") -> DataFrame:
    return samples.groupBy("metric", "ts", *labels).agg(F.sum(value).alias(value))


def histogram_quantile(buckets: DataFrame, keys: list[str], quantiles: list[float], value: str = "value") -> DataFrame:
    """Quantiles from cumulative buckets `(*keys, le, value)`, linear inside the bucket: one row per keys and `q`.

    An empty histogram has no row. All quantiles come from one pass; a group has as many rows as there are buckets.
    """
    upper = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double"))
    b = buckets.select(*keys, upper.alias("upper"), F.col(value).alias("cum"))
    order = Window.partitionBy(*keys).orderBy("upper")
    total = F.max("cum").over(Window.partitionBy(*keys))
    placed = b.select(*keys, "upper", "cum", total.alias("total"),
                      F.lag("cum", 1, 0.0).over(order).alias("cum_below"),
                      F.lag("upper", 1, 0.0).over(order).alias("lower"))

    def estimate(q: float) -> Column:
        rank = F.col("total") * q
        inside = F.col("lower") + (F.col("upper") - F.col("lower")) * (rank - F.col("cum_below")) / F.nullif(
            F.col("cum") - F.col("cum_below"), F.lit(0.0))
        reached = F.col("cum") >= rank
        return F.min_by(F.when(F.col("upper") == float("inf"), F.col("lower")).otherwise(inside),
                        F.when(reached, F.col("upper")))

    found = placed.filter(F.col("total") > 0).groupBy(*keys).agg(F.array(*[
        F.struct(F.lit(q).alias("q"), estimate(q).alias("quantile")) for q in quantiles]).alias("found"))
    return found.select(*keys, F.explode("found").alias("f")).select(*keys, "f.q", "f.quantile")


def ratio(samples: DataFrame, keys: list[str], part: Column, whole: Column, value: str = "value",
          scale: float = 1.0) -> DataFrame:
    """Sum of `value` where `part` holds over the sum where `whole` holds, per `keys`; null for an empty whole."""
    sums = samples.groupBy(*keys).agg(
        F.sum(F.when(part, F.col(value))).alias("_part"), F.sum(F.when(whole, F.col(value))).alias("_whole"))
    return sums.select(*keys, (F.try_divide(F.coalesce("_part", F.lit(0.0)), "_whole") * scale).alias("ratio"))


# Weight of each health colour.
HEALTH_WEIGHTS = {"green": 2.0, "yellow": 1.0, "red": 0.0}


def weighted_state(samples: DataFrame, keys: list[str], state: str = "state", value: str = "value") -> DataFrame:
    weights = F.create_map(*[F.lit(x) for pair in HEALTH_WEIGHTS.items() for x in pair])
    return samples.groupBy(*keys).agg(
        F.sum(F.coalesce(F.try_element_at(weights, F.col(state)), F.lit(0.0)) * F.col(value)).alias("health"))


@dataclass(frozen=True)
class AlertRule:
    name: str
    signal: str
    op: str
    threshold: float
    for_minutes: int
    severity: str


# The alert rules. Signals are gauges, rates and ratios computed by the functions above.
ALERT_RULES = [
    AlertRule("ApplicationDown", "up", "==", 0, 1, "critical"),
    AlertRule("HighKafkaConsumerLag", "consumer_lag", ">", 10_000, 5, "warning"),
    AlertRule("KafkaDLQMessagesDetected", "dlq_increase", ">", 0, 1, "warning"),
    AlertRule("HighRecommendationLatency", "recommendation_p99_sec", ">", 0.1, 3, "warning"),
    AlertRule("HighKnnFailureRate", "knn_failed_rate", ">", 1, 3, "warning"),
    AlertRule("ElasticsearchClusterRed", "cluster_red", "==", 1, 1, "critical"),
    AlertRule("HighESBulkFailureRate", "bulk_failed_rate", ">", 0, 5, "warning"),
    AlertRule("RedisHighMemoryUsage", "redis_memory_ratio", ">", 0.8, 5, "warning"),
    AlertRule("HighJVMHeapUsage", "jvm_heap_ratio", ">", 0.85, 5, "warning"),
]


def alerts(signals: DataFrame, rules: list[AlertRule] = ALERT_RULES) -> DataFrame:
    """Firings of each rule on `signals(signal, label, ts, value)`.

    A run of samples for which the condition holds fires once it has lasted `for_minutes`, at the first such sample.
    """
    columns = ["alert", "signal", "op", "threshold", "for_sec", "severity"]
    table = signals.sparkSession.createDataFrame(
        [(r.name, r.signal, r.op, float(r.threshold), r.for_minutes * 60, r.severity) for r in rules], columns)
    checked = signals.join(F.broadcast(table), "signal").withColumn("active", F.when(
        F.col("op") == ">", F.col("value") > F.col("threshold")).otherwise(F.col("value") == F.col("threshold")))
    order = Window.partitionBy("alert", "label").orderBy("ts")
    breaks = checked.withColumn("run", F.sum((~F.col("active")).cast("int")).over(order)).filter("active")
    since = F.min("ts").over(Window.partitionBy("alert", "label", "run"))
    aged = breaks.withColumn("active_since", since).withColumn(
        "lasted", F.unix_seconds("ts") - F.unix_seconds("active_since"))
    return (aged.groupBy("alert", "severity", "label", "run", "active_since")
            .agg(F.min(F.when(F.col("lasted") >= F.col("for_sec"), F.col("ts"))).alias("fired_at"),
                 F.max("ts").alias("last_active"))
            .filter(F.col("fired_at").isNotNull()).drop("run"))


def run_timeseries(samples: DataFrame, metrics: list[str], every_sec: int = 3) -> DataFrame:
    """Per run and `every_sec` bucket, the latest value of each metric, as columns: `samples(run_id, metric, ts, value)`."""
    bucket = F.call_function("div", F.unix_seconds("ts"), F.lit(every_sec)) * every_sec
    wide = samples.groupBy("run_id", bucket.alias("at_sec")).agg(*[
        F.max_by(F.when(F.col("metric") == m, F.col("value")),
                 F.when(F.col("metric") == m, F.col("ts"))).alias(m) for m in metrics])
    starts = samples.groupBy("run_id").agg(F.min("ts").alias("t0"))
    first = (F.call_function("div", F.unix_seconds("t0"), F.lit(every_sec)) * every_sec)
    return wide.join(starts, "run_id").withColumn("elapsed_sec", F.col("at_sec") - first).drop("t0")


# The compared metrics of two runs and whether less is better.
COMPARED = {
    "recApiP95Ms": True, "recApiP99Ms": True, "kafkaConsumerLag": True, "avgLatencyMs": True,
    "totalRequestsSent": False, "totalErrors": True, "kafkaProcessedRate": False, "esBulkSuccessRate": False,
}


def compare_runs(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Metric by metric, run `b` against run `a`: `runs(id, *metrics)`, `pairs(a_id, b_id)`."""
    long = runs.unpivot("id", [F.col(m).cast("double").alias(m) for m in COMPARED], "metric", "value")
    a = long.select(F.col("id").alias("a_id"), "metric", F.col("value").alias("a_value"))
    b = long.select(F.col("id").alias("b_id"), "metric", F.col("value").alias("b_value"))
    less = F.create_map(*[F.lit(x) for pair in COMPARED.items() for x in pair])
    delta = F.col("b_value") - F.col("a_value")
    better = F.when(less[F.col("metric")], -delta).otherwise(delta)
    return (pairs.join(a, "a_id").join(b, ["b_id", "metric"]).withColumn("delta", delta)
            .withColumn("verdict", F.when(delta.isNull(), "unknown").when(better > 0, "improved")
                        .when(better < 0, "worsened").otherwise("same")))


def run_summaries(results: DataFrame) -> DataFrame:
    """Runs newest first with the headline metrics."""
    m = [F.col(f"finalMetrics.{c}").alias(c) for c in (
        "recApiP95Ms", "recApiP99Ms", "kafkaConsumerLag", "totalErrors", "totalRequestsSent", "avgLatencyMs")]
    return results.select("id", "scenario", "startedAt", "durationSec", "note", *m).orderBy(F.desc("startedAt"), "id")
