"""Domain frames over the given tables.

Every derivation is row-local or a plain join/aggregation, so the frames scale with the tables behind them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Instant the time-relative operators are evaluated at on the given data.
AS_OF = "2024-01-31 00:00:00"
AS_OF_TIME = dt.datetime.fromisoformat(AS_OF)

SPANS_PER_TRACE = 8
TRACE_EPOCH_US = 1_706_000_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of() -> "F.Column":
    return F.to_timestamp(F.lit(AS_OF))


def user_actions_of(events: DataFrame) -> DataFrame:
    """Works for a batch or a streaming `events` frame."""
    return events.select(
        F.concat(F.lit("T"), "event_id").alias("trace_id"),
        "event_id", "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.upper("event_type").alias("action_type"),
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
    )


def user_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_actions_of(table(spark, sf_dir, "events"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("float").alias("price"),
        (F.col("p_size") % 5).alias("stock"),
        F.concat_ws(" ", F.lit("a"), "p_name", F.lit("by"), "p_brand").alias("description"),
        (F.lit(1672531200000) + F.col("p_partkey") * 60000).alias("created_at_ms"),
    )


def product_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("product_id"), F.col("embedding").alias("product_vector"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with their vector, null where there is none."""
    return products(spark, sf_dir).join(product_vectors(spark, sf_dir), "product_id", "left")


def categorised(actions: DataFrame, goods: DataFrame) -> DataFrame:
    """Actions with the category of their product."""
    return actions.join(goods.select("product_id", "category"), "product_id", "left")


def inventory_events_of(events: DataFrame) -> DataFrame:
    """Purchases stand for price changes, clicks for stock changes, the rest for product updates."""
    value = F.col("value")
    price = F.col("event_type") == "purchase"
    stock = F.col("event_type") == "click"
    return events.select(
        F.concat(F.lit("I"), "event_id").alias("inventory_event_id"),
        F.col("event_id").alias("seq"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.when(price, "PRICE_CHANGE").when(stock, "STOCK_CHANGE").otherwise("PRODUCT_UPDATE").alias("event_type"),
        F.when(price, (value * (F.lit(90) + F.col("event_id") % 40) / 100).cast("float")).alias("previous_price"),
        F.when(price, value.cast("float")).alias("current_price"),
        F.when(stock, (F.col("event_id") % 3).cast("int")).alias("previous_stock"),
        F.when(stock, (F.col("event_id") % 4).cast("int")).alias("current_stock"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def inventory_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory_events_of(table(spark, sf_dir, "events"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One span per event; eight consecutive events form a trace, linked as a binary heap.

    The last span of a full trace points at a parent that does not exist, process `p-error` has no entry.
    """
    return spans_of(table(spark, sf_dir, "events"))


def spans_of(e: DataFrame) -> DataFrame:
    n = F.lit(SPANS_PER_TRACE)
    pos = F.pmod(F.col("event_id"), n)
    trace_no = F.call_function("div", F.col("event_id"), n)
    k = F.get_json_object("props", "$.k")
    value = F.col("value")

    def tag(key, type_, val):
        return F.struct(F.lit(key).alias("key"), F.lit(type_).alias("type"), val.cast("string").alias("value"))

    tags = F.filter(F.array(
        F.when(F.col("event_type") == "error", tag("error", "bool", F.lit("true"))),
        F.when(value > 480, tag("otel.status_code", "string", F.lit("ERROR"))),
        F.when(F.col("event_type") == "error", tag("error.message", "string", F.concat(F.lit("code "), k))),
        F.when(k == "7", tag("messaging.destination.name", "string", F.concat("event_type", F.lit(".v1.dlq")))),
    ), lambda t: t.isNotNull())
    services = F.create_map(*[x for s in ("view", "click", "purchase", "signup") for x in (
        F.lit(f"p-{s}"), F.struct(F.lit(f"{s}-service").alias("serviceName")))])
    return e.select(
        F.concat(F.lit("TR"), trace_no).alias("trace_id"),
        F.col("event_id").alias("span_id"),
        F.when(pos == 0, None).when(pos == 7, -F.col("event_id"))
         .otherwise(F.col("event_id") - pos + F.call_function("div", pos - 1, F.lit(2))).alias("parent_id"),
        F.when(k == "11", F.concat(F.lit("orders.DLQ "), "event_type")).otherwise(F.col("event_type")).alias("operation_name"),
        F.concat(F.lit("p-"), "event_type").alias("process_id"),
        services.alias("processes"),
        (F.lit(TRACE_EPOCH_US) + trace_no * 1_000_000 + pos * F.floor(value * 100)).cast("bigint").alias("start_us"),
        F.floor(value * 1000).cast("bigint").alias("duration_us"),
        tags.alias("tags"),
        pos.cast("int").alias("position"),
    )


# Upper bounds of the latency buckets; the last one is +Inf.
BUCKET_BOUNDS = ["1", "5", "10", "50", "100", "500", "+Inf"]


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter samples every ten minutes and event type; the counters restart at midnight.

    Long format (metric, label, le, ts, value): `events_total`, `errors_total` and `latency_bucket`.
    Counting is per (type, interval) first, so the running sums only see one row per scrape.
    """
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events").select(
        "event_type", "value",
        F.timestamp_seconds(F.call_function("div", F.unix_seconds(F.col("ts").cast("timestamp")), F.lit(600)) * 600).alias("ts"))
    below = [F.count_if(F.col("value") <= float(b)) if b != "+Inf" else F.count("*") for b in BUCKET_BOUNDS]
    per_scrape = e.groupBy("event_type", "ts").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") > 400).alias("errors"),
        *[c.alias(f"b{i}") for i, c in enumerate(below)])
    series = per_scrape.select("event_type", "ts", F.explode(F.array(
        F.struct(F.lit("events_total").alias("metric"), F.lit(None).cast("string").alias("le"), F.col("n").alias("inc")),
        F.struct(F.lit("errors_total").alias("metric"), F.lit(None).cast("string").alias("le"), F.col("errors").alias("inc")),
        *[F.struct(F.lit("latency_bucket").alias("metric"), F.lit(b).alias("le"), F.col(f"b{i}").alias("inc"))
          for i, b in enumerate(BUCKET_BOUNDS)])).alias("s")).select("event_type", "ts", "s.*")
    run = (Window.partitionBy("metric", "event_type", "le", F.to_date("ts")).orderBy("ts")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return series.select("metric", F.col("event_type").alias("label"), "le", "ts",
                         F.sum("inc").over(run).cast("double").alias("value"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON log line per event, in three time formats; every line of user 13 is cut short."""
    ts = F.col("ts").cast("timestamp")
    stamp = (F.when(F.col("event_id") % 3 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'"))
             .when(F.col("event_id") % 3 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
             .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    line = F.to_json(F.struct(
        F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "signup", "WARN")
         .otherwise("INFO").alias("level"),
        F.concat(F.lit("user "), "user_id", F.lit(" did "), "event_type").alias("message"),
        F.concat(F.lit("shop."), "event_type").alias("logger_name"),
        F.concat(F.lit("worker-"), F.col("event_id") % 4).alias("thread_name"),
        F.concat(F.lit("T"), "event_id").alias("traceId"),
        F.concat(F.lit("S"), "event_id").alias("spanId"),
        stamp.alias("@timestamp"),
        F.concat("event_type", F.lit("-app")).alias("application"),
        F.when(F.col("event_type") == "error", "at shop.Main").alias("stack_trace")))
    cut = F.when(F.col("user_id") == 13, F.substring(line, 1, 40)).otherwise(line)
    return table(spark, sf_dir, "events").select("event_id", ts.alias("ingested_at"), cut.alias("line"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempts_of(table(spark, sf_dir, "events"))


def attempts_of(events: DataFrame) -> DataFrame:
    """A dense send log: one attempt per event, twenty seconds apart."""
    return events.select(
        F.concat(F.lit("A"), "event_id").alias("attempt_id"), "user_id",
        (F.get_json_object("props", "$.k").cast("bigint") % 10).alias("product_id"),
        F.when(F.col("event_type") == "purchase", "PRICE_DROP").when(F.col("event_type") == "click", "BACK_IN_STOCK")
         .otherwise("RECOMMENDATION").alias("notification_type"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("event_id") * 20).alias("ts"),
        F.col("event_id").alias("seq"))


def notifications_of(events: DataFrame) -> DataFrame:
    """One notification per event; two consecutive events share an id, errors ask for an unknown channel."""
    def channels(*names):
        return F.array(*[F.lit(n) for n in names])

    return events.select(
        F.concat(F.lit("N"), F.call_function("div", F.col("event_id"), F.lit(2))).alias("notification_id"),
        "event_id", "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.when(F.col("event_type") == "purchase", "PRICE_DROP").when(F.col("event_type") == "click", "BACK_IN_STOCK")
         .otherwise("RECOMMENDATION").alias("notification_type"),
        F.when(F.col("event_type") == "error", channels("FAX"))
         .when(F.col("event_type") == "click", channels("PUSH", "SMS")).otherwise(channels("PUSH", "IN_APP")).alias("channels"),
        F.col("ts").cast("timestamp").alias("ts"))


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notifications_of(table(spark, sf_dir, "events"))


def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored findings and bookmarks: slow, failed or purchase events."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.concat(F.lit("TR"), F.call_function("div", F.col("event_id"), F.lit(SPANS_PER_TRACE))).alias("trace_id"),
        "event_id",
        F.when(F.col("event_type") == "error", "ERROR_SPAN").when(F.col("value") > 250, "SLOW_TRACE")
         .otherwise("unheard-of").alias("type"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("odd").alias("severity"),
        F.concat("event_type", F.lit("-service")).alias("service_name"),
        (F.col("event_type") == "signup").alias("is_bookmark"),
        F.floor("value").cast("bigint").alias("duration_ms"),
        F.concat(F.lit("note "), F.col("event_id") % 7).alias("note"),
        ts.alias("detected_at"), ts.alias("created_at"))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load run per day of events with its final metrics."""
    k = F.get_json_object("props", "$.k").cast("double")
    day = F.to_date(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").groupBy(day.alias("day")).agg(
        F.max(k).alias("kafkaConsumerLag"),
        (F.count("*") / 86400).alias("kafkaProcessedRate"),
        (F.count_if(F.col("event_type") == "purchase") / 86400).alias("esBulkSuccessRate"),
        F.min("value").alias("recApiP50Ms"), (F.max("value") * 0.75).alias("recApiP95Ms"),
        F.max("value").alias("recApiP99Ms"),
        F.count("*").alias("totalRequestsSent"), F.count_if(F.col("event_type") == "error").alias("totalErrors"),
        F.round(F.avg("value"), 6).alias("avgLatencyMs"),
    ).withColumn("id", F.concat(F.lit("lt-"), F.col("day").cast("string")))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert signals per event type and ten-minute scrape, from the counts of that scrape."""
    per = table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("label"),
        F.timestamp_seconds(F.call_function("div", F.unix_seconds(F.col("ts").cast("timestamp")), F.lit(600)) * 600).alias("ts"),
    ).agg(F.count("*").alias("n"), F.max("value").alias("top"))
    n, top = F.col("n").cast("double"), F.col("top")
    values = {
        "up": F.when(top > 450, 0.0).otherwise(1.0), "consumer_lag": n * top * 100, "dlq_increase": F.greatest(n - 1, F.lit(0.0)),
        "recommendation_p99_sec": top / 1000, "knn_failed_rate": n / 2, "cluster_red": F.when(top < 1, 1.0).otherwise(0.0),
        "bulk_failed_rate": F.greatest(n - 2, F.lit(0.0)), "redis_memory_ratio": top / 100, "jvm_heap_ratio": top / 490,
    }
    return per.select("label", "ts", F.explode(F.array(*[
        F.struct(F.lit(s).alias("signal"), v.alias("value")) for s, v in values.items()])).alias("s")).select(
        F.col("s.signal").alias("signal"), "label", "ts", F.col("s.value").alias("value"))
