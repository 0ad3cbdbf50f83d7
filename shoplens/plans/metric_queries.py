"""Queries over metric series, alerts and load runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.operators import metrics as M
from shoplens.plans.registry import query
from shoplens.session import scratch_path
from shoplens.sources import adapters as A
from shoplens.sources import files

HOUR = 3600
BOUNDS = A.BUCKET_BOUNDS

_INCREMENTS = ["SELECT 'events_total' AS metric, label, NULL AS le, at_sec, n AS inc FROM per",
               "SELECT 'errors_total', label, NULL, at_sec, errors FROM per",
               *[f"SELECT 'latency_bucket', label, '{b}', at_sec, b{i} FROM per" for i, b in enumerate(BOUNDS)]]
SAMPLES = f"""
per AS (SELECT event_type AS label, epoch_us(ts) // 600000000 * 600 AS at_sec, count(*) AS n, count(*) FILTER (value > 400) AS errors,
  {', '.join((f"count(*) FILTER (value <= {b})" if b != '+Inf' else 'count(*)') + f' AS b{i}' for i, b in enumerate(BOUNDS))}
  FROM events GROUP BY ALL),
increments AS ({' UNION ALL '.join(_INCREMENTS)}),
samples AS (SELECT metric, label, le, at_sec, CAST(sum(inc) OVER (PARTITION BY metric, label, le, at_sec // 86400 ORDER BY at_sec) AS DOUBLE) AS value
            FROM increments)"""
INCREASE = """
stepped AS (SELECT *, lag(value) OVER w AS before FROM samples WINDOW w AS (PARTITION BY metric, label, le ORDER BY at_sec)),
steps AS (SELECT *, CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END AS step FROM stepped),
increase AS (SELECT metric, label, le, at_sec, sum(step) OVER (PARTITION BY metric, label, le ORDER BY at_sec
             RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW) AS increase FROM steps)"""


def _at(df):
    return df.withColumn("at_sec", F.unix_seconds("ts")).drop("ts")


@query("read_metric_samples", SAMPLES, sql="SELECT * FROM samples")
def _(spark, d):
    return _at(A.metric_samples(spark, d))


@query("counter_rate", SAMPLES, INCREASE,
       sql="SELECT metric, label, le, at_sec, round(increase / 3600, 9) AS rate FROM increase")
def _(spark, d):
    return _at(M.counter_rate(A.metric_samples(spark, d), HOUR)).withColumn("rate", F.round("rate", 9))


@query("counter_increase", SAMPLES, INCREASE, sql="""
SELECT metric, label, at_sec, increase FROM increase WHERE metric IN ('events_total', 'errors_total')""")
def _(spark, d):
    plain = A.metric_samples(spark, d).filter(F.col("metric").isin("events_total", "errors_total"))
    return _at(M.counter_increase(plain, HOUR)).drop("le")


@query("sum_by_label", SAMPLES, sql="SELECT metric, le, at_sec, sum(value) AS value FROM samples GROUP BY ALL")
def _(spark, d):
    return _at(M.sum_by_label(A.metric_samples(spark, d), ["le"]))


@query("histogram_quantile", SAMPLES, INCREASE, """
buckets AS (SELECT at_sec, CASE WHEN le = '+Inf' THEN 'Infinity'::DOUBLE ELSE CAST(le AS DOUBLE) END AS upper, sum(increase) AS cum
            FROM increase WHERE metric = 'latency_bucket' GROUP BY ALL),
placed AS (SELECT *, lag(cum, 1, 0) OVER w AS below, lag(upper, 1, 0) OVER w AS lower, max(cum) OVER (PARTITION BY at_sec) AS total
           FROM buckets WINDOW w AS (PARTITION BY at_sec ORDER BY upper)),
qs AS (SELECT unnest([0.5, 0.95, 0.99]) AS q)""", sql="""
SELECT q, at_sec, round(arg_min(CASE WHEN upper = 'Infinity' THEN lower ELSE lower + (upper - lower) * (total * q - below) / (cum - below) END, upper), 6) AS quantile
FROM placed, qs WHERE total > 0 AND cum >= total * q GROUP BY q, at_sec""")
def _(spark, d):
    rates = M.counter_increase(A.metric_samples(spark, d).filter(F.col("metric") == "latency_bucket"), HOUR)
    buckets = M.sum_by_label(rates, ["le"], "increase")
    found = M.histogram_quantile(buckets, ["ts"], [0.5, 0.95, 0.99], "increase")
    return _at(found).withColumn("quantile", F.round("quantile", 6))


@query("ratio", SAMPLES, INCREASE, sql="""
SELECT at_sec, round(CASE WHEN coalesce(sum(increase) FILTER (metric = 'events_total'), 0) <> 0 THEN
  coalesce(sum(increase) FILTER (metric = 'errors_total'), 0) / sum(increase) FILTER (metric = 'events_total') * 100 END, 6) AS ratio
FROM increase GROUP BY at_sec""")
def _(spark, d):
    grown = M.counter_increase(A.metric_samples(spark, d), HOUR)
    share = M.ratio(grown, ["ts"], F.col("metric") == "errors_total", F.col("metric") == "events_total", "increase", 100.0)
    return _at(share).withColumn("ratio", F.round("ratio", 6))


@query("weighted_state", SAMPLES, INCREASE, sql="""
SELECT at_sec, sum(CASE label WHEN 'purchase' THEN 2.0::DOUBLE WHEN 'view' THEN 1.0 ELSE 0.0 END * (increase > 0)::INT) AS health
FROM increase WHERE metric = 'events_total' GROUP BY at_sec""")
def _(spark, d):
    grown = M.counter_increase(A.metric_samples(spark, d).filter(F.col("metric") == "events_total"), HOUR)
    colour = F.when(F.col("label") == "purchase", "green").when(F.col("label") == "view", "yellow").otherwise("red")
    states = grown.select("ts", colour.alias("state"), (F.col("increase") > 0).cast("double").alias("value"))
    return _at(M.weighted_state(states, ["ts"]))


_SIGNALS = {
    "up": "CASE WHEN top > 450 THEN 0.0 ELSE 1.0 END", "consumer_lag": "n * top * 100", "dlq_increase": "greatest(n - 1, 0)",
    "recommendation_p99_sec": "top / 1000", "knn_failed_rate": "n / 2", "cluster_red": "CASE WHEN top < 1 THEN 1.0 ELSE 0.0 END",
    "bulk_failed_rate": "greatest(n - 2, 0)", "redis_memory_ratio": "top / 100", "jvm_heap_ratio": "top / 490",
}


@query("alerts", f"""
per AS (SELECT event_type AS label, epoch_us(ts) // 600000000 * 600 AS at_sec, CAST(count(*) AS DOUBLE) AS n, max(value) AS top
        FROM events GROUP BY ALL),
signals AS ({' UNION ALL '.join(f"SELECT '{s}' AS signal, label, at_sec, CAST({e} AS DOUBLE) AS value FROM per" for s, e in _SIGNALS.items())}),
rules(alert, signal, op, threshold, for_sec, severity) AS (VALUES
  {', '.join(f"('{r.name}', '{r.signal}', '{r.op}', {float(r.threshold)}, {r.for_minutes * 60}, '{r.severity}')" for r in M.ALERT_RULES)}),
checked AS (SELECT *, CASE WHEN op = '>' THEN value > threshold ELSE value = threshold END AS active FROM signals JOIN rules USING (signal)),
islands AS (SELECT *, sum((NOT active)::INT) OVER (PARTITION BY alert, label ORDER BY at_sec) AS run FROM checked),
aged AS (SELECT *, min(at_sec) OVER (PARTITION BY alert, label, run) AS since FROM islands WHERE active)""", sql="""
SELECT alert, severity, label, since AS active_since, min(at_sec) FILTER (at_sec - since >= for_sec) AS fired_at, max(at_sec) AS last_active
FROM aged GROUP BY alert, severity, label, run, since HAVING min(at_sec) FILTER (at_sec - since >= for_sec) IS NOT NULL""")
def _(spark, d):
    fired = M.alerts(A.signals(spark, d))
    return fired.withColumns({c: F.unix_seconds(c) for c in ("active_since", "fired_at", "last_active")})


RUN_SERIES = ["kafkaConsumerLag", "recApiP95Ms", "kafkaProcessedRate"]


@query("run_timeseries", """
raw AS (SELECT concat('lt-', CAST(ts AS DATE)) AS run_id, epoch_us(ts) // 1000000 // 3600 * 3600 AS at_sec, ts, event_id, event_type, value FROM events),
starts AS (SELECT run_id, min(at_sec) AS t0 FROM raw GROUP BY run_id)""", sql="""
SELECT run_id, at_sec, at_sec - t0 AS elapsed_sec, arg_max(value, ts) FILTER (event_type = 'view') AS "kafkaConsumerLag",
  arg_max(value, ts) FILTER (event_type = 'click') AS "recApiP95Ms", arg_max(value, ts) FILTER (event_type = 'purchase') AS "kafkaProcessedRate"
FROM raw JOIN starts USING (run_id) GROUP BY run_id, at_sec, t0""")
def _(spark, d):
    ts = F.col("ts").cast("timestamp")
    names = dict(zip(("view", "click", "purchase"), RUN_SERIES))
    metric = F.try_element_at(F.create_map(*[F.lit(x) for p in names.items() for x in p]), F.col("event_type"))
    samples = A.table(spark, d, "events").select(
        F.concat(F.lit("lt-"), F.to_date(ts).cast("string")).alias("run_id"), metric.alias("metric"), ts.alias("ts"), "value")
    return M.run_timeseries(samples, RUN_SERIES, every_sec=HOUR)


RUNS = """
runs AS (SELECT concat('lt-', CAST(ts AS DATE)) AS id, CAST(ts AS DATE) AS day,
    CAST(max(CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)) AS DOUBLE) AS "kafkaConsumerLag",
    count(*) / 86400 AS "kafkaProcessedRate", count(*) FILTER (event_type = 'purchase') / 86400 AS "esBulkSuccessRate",
    min(value) AS "recApiP50Ms", max(value) * 0.75 AS "recApiP95Ms", max(value) AS "recApiP99Ms", count(*) AS "totalRequestsSent",
    count(*) FILTER (event_type = 'error') AS "totalErrors", round(avg(value), 6) AS "avgLatencyMs" FROM events GROUP BY ALL)"""


@query("compare_runs", RUNS, f"""
long AS MATERIALIZED (SELECT id, day, unnest([{', '.join(f"""{{'metric': '{m}', 'value': CAST("{m}" AS DOUBLE), 'less': {str(less).lower()}}}""" for m, less in M.COMPARED.items())}], recursive := true) FROM runs)""",
       sql="""
SELECT a.id AS a_id, b.id AS b_id, metric, round(a.value, 6) AS a_value, round(b.value, 6) AS b_value, round(b.value - a.value, 6) AS delta,
  CASE WHEN b.value - a.value IS NULL THEN 'unknown' WHEN (b.value - a.value) * (CASE WHEN a.less THEN -1 ELSE 1 END) > 0 THEN 'improved'
       WHEN (b.value - a.value) * (CASE WHEN a.less THEN -1 ELSE 1 END) < 0 THEN 'worsened' ELSE 'same' END AS verdict
FROM long a JOIN long b USING (metric) WHERE b.day = a.day + INTERVAL 1 DAY""")
def _(spark, d):
    runs = A.run_metrics(spark, d)
    pairs = (runs.select(F.col("id").alias("a_id"), F.date_add("day", 1).alias("day"))
             .join(runs.select("day", F.col("id").alias("b_id")), "day").select("a_id", "b_id"))
    return M.compare_runs(runs, pairs).withColumns({c: F.round(c, 6) for c in ("a_value", "b_value", "delta")})


def _run_files(spark, d):
    """The runs as JSON files, one per run, next to one that cannot be read."""
    runs = A.run_metrics(spark, d)
    metrics = [c for c in runs.columns if c not in ("id", "day")]
    start = F.concat(F.col("day").cast("string"), F.lit("T00:00:00Z"))
    record = F.to_json(F.struct(
        "id", F.lit("MIXED").alias("scenario"), start.alias("startedAt"), F.lit(86400).alias("durationSec"),
        F.struct(*metrics).alias("finalMetrics"), F.lit("").alias("note")))
    path = scratch_path(spark, "runs")
    days = runs.select(record.alias("value"), "day").unionByName(
        runs.agg(F.max("day").alias("day")).select(F.lit('{"id": "cut').alias("value"), F.date_add("day", 1).alias("day")))
    days.repartition("day").write.partitionBy("day").text(path)
    return path


@query("read_run_results", RUNS, sql="""
SELECT id, 86400 AS "durationSec", "totalRequestsSent", "totalErrors", round("avgLatencyMs", 6) AS "avgLatencyMs" FROM runs""")
def _(spark, d):
    rows = files.read_run_results(spark, _run_files(spark, d))
    return rows.select("id", "durationSec", "finalMetrics.totalRequestsSent", "finalMetrics.totalErrors",
                       F.round("finalMetrics.avgLatencyMs", 6).alias("avgLatencyMs"))


@query("run_summaries", RUNS, sql="""
SELECT id, 'MIXED' AS scenario, concat(day, 'T00:00:00Z') AS "startedAt", 86400 AS "durationSec", '' AS note,
  round("recApiP95Ms", 6) AS "recApiP95Ms", "recApiP99Ms", "kafkaConsumerLag", "totalErrors", "totalRequestsSent",
  round("avgLatencyMs", 6) AS "avgLatencyMs" FROM runs""")
def _(spark, d):
    return M.run_summaries(files.read_run_results(spark, _run_files(spark, d))).withColumns({
        c: F.round(c, 6) for c in ("recApiP95Ms", "avgLatencyMs")})
