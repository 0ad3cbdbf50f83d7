"""Queries over actions and products: reading, filtering, ranking, counting, scalar rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.functions import actions as FA
from shoplens.functions import text as FT
from shoplens.functions import vectors as FV
from shoplens.operators import filters, interest, popularity, recommend, reports, topk
from shoplens.plans.registry import (
    ACTIONS, ACTIVE, ALPHA, AS_OF_SQL, CATALOG, CATEGORISED, DIMS, PRODUCTS, VECTORS, VIEWED, popular_sql, query, unit_sql)
from shoplens.schemas import ACTION_TYPES
from shoplens.sources import adapters as A

WEEK = f"ts >= {AS_OF_SQL} - INTERVAL 7 DAY AND ts <= {AS_OF_SQL}"
GOODS4 = "product_id, product_name, category, CAST(price AS DOUBLE) AS price"


def e4(vector):
    """A vector as text of integers (1e-4 units), for comparison across engines."""
    return F.array_join(F.transform(vector, lambda x: F.round(x * 10000).cast("bigint").cast("string")), ",")


def e4_sql(vector: str) -> str:
    return f"array_to_string(list_transform({vector}, lambda q: CAST(round(q * 10000) AS BIGINT)), ',')"


# --- sources, projections, predicates

@query("read_user_actions", ACTIONS, sql="SELECT * FROM ua")
def _(spark, d):
    return A.user_actions(spark, d)


@query("read_catalog", ACTIONS, PRODUCTS,
       sql=f"SELECT {GOODS4}, brand, stock FROM goods WHERE product_id IN (SELECT product_id FROM ua)")
def _(spark, d):
    return filters.get_products(A.products(spark, d), A.user_actions(spark, d)).select(
        "product_id", "product_name", "category", "price", "brand", "stock")


@query("project_behavior", ACTIONS,
       sql="SELECT coalesce(trace_id, '') AS trace_id, user_id, product_id, action_type, epoch_us(ts) // 1000 AS timestamp_ms FROM ua")
def _(spark, d):
    return filters.project_behavior(A.user_actions(spark, d))


@query("valid_products", PRODUCTS, sql=f"""SELECT {GOODS4} FROM goods WHERE trim(CAST(product_id AS VARCHAR)) <> ''
       AND trim(product_name) <> '' AND trim(category) <> '' AND price >= 0""")
def _(spark, d):
    return filters.source_projection(filters.valid_products(A.products(spark, d)))


@query("has_vector", PRODUCTS, VECTORS, CATALOG,
       sql="SELECT product_id, coalesce(len(product_vector) = 64, false) AS usable FROM full_catalog")
def _(spark, d):
    return A.catalog(spark, d).select("product_id", FV.has_vector(F.col("product_vector"), DIMS).alias("usable"))


@query("filter_actions", ACTIONS, PRODUCTS, CATEGORISED,
       sql="""SELECT event_id, user_id, product_id, action_type, category FROM ca
              WHERE action_type IN ('VIEW', 'CLICK') AND category = 'SMALL'""")
def _(spark, d):
    actions = A.categorised(A.user_actions(spark, d), A.products(spark, d))
    return filters.filter_actions(actions, ["VIEW", "CLICK"], "SMALL").select(
        "event_id", "user_id", "product_id", "action_type", "category")


@query("recent_window", ACTIONS, sql=f"SELECT event_id, user_id, product_id FROM ua WHERE {WEEK}")
def _(spark, d):
    return filters.recent_window(A.user_actions(spark, d), A.as_of(), 7).select("event_id", "user_id", "product_id")


@query("in_stock", PRODUCTS, sql="SELECT product_id, stock FROM goods WHERE stock > 0")
def _(spark, d):
    return filters.in_stock(A.products(spark, d)).select("product_id", "stock")


@query("source_projection", PRODUCTS, sql=f"SELECT {GOODS4} FROM goods")
def _(spark, d):
    return filters.source_projection(A.products(spark, d))


# --- popularity, interest, recency

@query("popular_products", ACTIONS, PRODUCTS, popular_sql(100),
       sql="SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, rank, CAST(tier AS BIGINT) AS tier, score FROM popular")
def popular_products(spark, d):
    return popularity.popular_products(A.user_actions(spark, d), A.products(spark, d), A.as_of())


@query("category_best", ACTIONS, PRODUCTS, CATEGORISED, f"""
tiers AS (SELECT 1 AS tier, category, product_id, count(*) AS n FROM ca WHERE action_type = 'PURCHASE' AND {WEEK} GROUP BY ALL
          UNION ALL SELECT 2, category, product_id, count(*) FROM ca WHERE action_type IN ('VIEW', 'CLICK') AND {WEEK} GROUP BY ALL
          UNION ALL SELECT 3, category, product_id, created_at_ms FROM goods),
chosen AS (SELECT *, row_number() OVER (PARTITION BY category, tier ORDER BY n DESC, product_id) AS rank FROM tiers
           WHERE category IS NOT NULL QUALIFY tier = min(tier) OVER (PARTITION BY category))""",
       sql="""SELECT category, product_id, product_name, CAST(price AS DOUBLE) AS price, rank, CAST(tier AS BIGINT) AS tier, 0.0::DOUBLE AS score
              FROM chosen JOIN goods USING (category, product_id) WHERE rank <= 50""")
def _(spark, d):
    goods = A.products(spark, d)
    return popularity.category_best(A.categorised(A.user_actions(spark, d), goods), goods, A.as_of())


@query("popular_details", ACTIONS, PRODUCTS, """
ranked AS (SELECT product_id, row_number() OVER (ORDER BY count(*) DESC, product_id) AS rank FROM ua GROUP BY product_id
           QUALIFY rank <= 20)""",
       sql=f"SELECT {GOODS4}, rank, 0.0::DOUBLE AS score FROM ranked JOIN goods USING (product_id)")
def _(spark, d):
    counts = A.user_actions(spark, d).groupBy("product_id").agg(F.count("*").alias("n"))
    ranked = topk.top_overall(counts, [F.desc("n"), F.asc("product_id")], 20).drop("n")
    return popularity.popular_details(ranked, A.products(spark, d))


@query("latest_products", PRODUCTS,
       sql=f"""SELECT {GOODS4}, created_at_ms, row_number() OVER (ORDER BY created_at_ms DESC, product_id) AS rank,
               0.0::DOUBLE AS score FROM goods QUALIFY rank <= 50""")
def _(spark, d):
    return topk.latest_products(A.products(spark, d), 50)


@query("interested_users", ACTIONS, sql=f"""
SELECT product_id, user_id, count(*) AS n, row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, user_id) AS rank
FROM ua WHERE action_type IN ('VIEW', 'CLICK', 'ADD_TO_CART') AND ts >= {AS_OF_SQL} - INTERVAL 30 DAY AND ts <= {AS_OF_SQL}
GROUP BY product_id, user_id QUALIFY rank <= 10000""")
def _(spark, d):
    return interest.interested_users(A.user_actions(spark, d), A.as_of(), interest.PRICE_DROP_ACTIONS,
                                     interest.PRICE_DROP_DAYS, interest.MAX_USERS)


@query("active_users", ACTIONS, ACTIVE, sql="SELECT user_id, n, rank FROM active")
def _(spark, d):
    return interest.active_users(A.user_actions(spark, d), A.as_of(), limit=interest.MAX_USERS)


@query("recent_viewed", ACTIONS, VIEWED, sql="SELECT user_id, product_id, rank FROM viewed")
def _(spark, d):
    return recommend.recent_viewed(A.user_actions(spark, d), A.as_of())


@query("recent_purchased", ACTIONS, sql=f"""
SELECT user_id, product_id, min(rank) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM ua
  WHERE action_type = 'PURCHASE' AND ts >= {AS_OF_SQL} - INTERVAL 30 DAY AND ts <= {AS_OF_SQL})
WHERE rank <= 50 GROUP BY user_id, product_id""")
def _(spark, d):
    return recommend.recent_purchased(A.user_actions(spark, d), A.as_of())


@query("exclude_viewed", ACTIONS, VIEWED,
       sql="SELECT DISTINCT user_id, product_id FROM ua WHERE action_type = 'PURCHASE' EXCEPT SELECT user_id, product_id FROM viewed")
def _(spark, d):
    actions = A.user_actions(spark, d)
    bought = filters.filter_actions(actions, ["PURCHASE"]).select("user_id", "product_id").distinct()
    return filters.exclude_viewed(bought, recommend.recent_viewed(actions, A.as_of()))


# --- counts

@query("events_by_user", ACTIONS, sql="""
SELECT user_id, count(*) AS events, arg_min(event_id, (ts, event_id)) AS first_event, arg_max(event_id, (ts, event_id)) AS last_event
FROM ua GROUP BY user_id""")
def _(spark, d):
    return reports.events_by_user(A.user_actions(spark, d)).groupBy("user_id").agg(
        F.count("*").alias("events"), F.min_by("event_id", F.struct("ts", "event_id")).alias("first_event"),
        F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event"))


@query("bulk_outcome", ACTIONS, sql=f"""
SELECT event_id // 500 AS batch_id, count(*) FILTER (action_type IN {tuple(ACTION_TYPES)}) AS succeeded,
  count(*) FILTER (action_type NOT IN {tuple(ACTION_TYPES)}) AS failed,
  count(*) FILTER (action_type NOT IN {tuple(ACTION_TYPES)}) > 0 AS batch_failed FROM ua GROUP BY 1""")
def _(spark, d):
    return reports.bulk_outcome(A.user_actions(spark, d).select(
        F.call_function("div", F.col("event_id"), F.lit(500)).alias("batch_id"),
        F.col("action_type").isin(ACTION_TYPES).alias("ok")))


@query("processing_funnel", ACTIONS, VECTORS, sql=f"""
SELECT count(*) AS processed, count(*) FILTER (known) AS indexed, count(*) FILTER (NOT known) AS failed,
  count(*) FILTER (known AND usable) AS preference_success, count(*) FILTER (known AND NOT usable) AS preference_skipped,
  count(*) FILTER (NOT known) AS dlq_sent
FROM (SELECT action_type IN {tuple(ACTION_TYPES)} AS known, coalesce(len(product_vector) = 64, false) AS usable
      FROM ua LEFT JOIN vectors USING (product_id))""")
def _(spark, d):
    from shoplens.operators.preferences import attach_vectors

    rows = attach_vectors(A.user_actions(spark, d), A.product_vectors(spark, d), DIMS)
    known, skipped = F.col("action_type").isin(ACTION_TYPES), F.col("skipped")
    return reports.processing_funnel(rows, {
        "processed": F.lit(True), "indexed": known, "failed": ~known, "preference_success": known & ~skipped,
        "preference_skipped": known & skipped, "dlq_sent": ~known})


@query("batch_size_percentiles", ACTIONS, sql="""
SELECT quantile_disc(size, 0.5) AS p50, quantile_disc(size, 0.9) AS p90, quantile_disc(size, 0.99) AS p99
FROM (SELECT count(*) AS size FROM ua GROUP BY user_id, CAST(ts AS DATE))""")
def _(spark, d):
    sizes = A.user_actions(spark, d).groupBy("user_id", F.to_date("ts")).agg(F.count("*").alias("size"))
    return reports.batch_size_percentiles(sizes)


@query("request_stats", ACTIONS, sql="""
SELECT count(*) AS total_requests, count(*) FILTER (action_type = 'ERROR') AS total_errors,
  round(coalesce(avg(value) FILTER (action_type <> 'ERROR'), 0), 6) AS avg_latency_ms FROM ua""")
def _(spark, d):
    requests = A.user_actions(spark, d).select(
        (F.col("action_type") != "ERROR").alias("ok"), F.col("value").alias("latency_ms"))
    return reports.request_stats(requests).withColumn("avg_latency_ms", F.round("avg_latency_ms", 6))


@query("catalog_counts", PRODUCTS, sql="SELECT category, count(*) AS products FROM goods GROUP BY category")
def _(spark, d):
    return reports.catalog_counts(A.products(spark, d))


@query("events_per_second", """
snaps AS (SELECT event_type AS series, epoch_us(ts) // 600000000 * 600 AS at_sec, count(*) AS n FROM events GROUP BY ALL),
counted AS (SELECT series, at_sec, sum(n) OVER (PARTITION BY series ORDER BY at_sec) AS total FROM snaps)""", sql="""
SELECT series, at_sec, CAST(total AS BIGINT) AS count,
  CAST(coalesce(floor((total - lag(total) OVER (PARTITION BY series ORDER BY at_sec)) / 3 + 0.5), 0) AS BIGINT) AS rate
FROM counted QUALIFY row_number() OVER (PARTITION BY series ORDER BY at_sec DESC) <= 20""")
def _(spark, d):
    from pyspark.sql import Window

    at = F.call_function("div", F.unix_seconds("ts"), F.lit(600)) * 600
    snaps = A.user_actions(spark, d).groupBy(F.lower("action_type").alias("series"), at.alias("ts")).agg(
        F.count("*").alias("n"))
    running = Window.partitionBy("series").orderBy("ts")
    counter = snaps.select("series", "ts", F.sum("n").over(running).alias("count"))
    return reports.events_per_second(counter).withColumnRenamed("ts", "at_sec")


# --- scalar rules

@query("action_alpha", ACTIONS, sql=f"SELECT event_id, action_type, {ALPHA} AS alpha FROM ua")
def _(spark, d):
    return A.user_actions(spark, d).select("event_id", "action_type", FA.action_alpha(F.lower("action_type")).alias("alpha"))


@query("l2_normalize", sql=f"""
SELECT vec_id AS product_id, {e4_sql(unit_sql('v'))} AS unit_e4
FROM (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * (label + 2)) AS v FROM embeddings)""")
def _(spark, d):
    scaled = A.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("product_id"),
        F.transform(FV.as_doubles(F.col("embedding")), lambda x: x * (F.col("label") + 2)).alias("v"))
    return scaled.select("product_id", e4(FV.l2_normalize(F.col("v"))).alias("unit_e4"))


@query("ema_step", ACTIONS, VECTORS, f"""
pairs AS (SELECT event_id, {ALPHA} AS alpha, CAST(a.product_vector AS DOUBLE[]) AS p, CAST(b.product_vector AS DOUBLE[]) AS v
          FROM ua JOIN vectors a ON a.product_id = ua.product_id JOIN vectors b ON b.product_id = ua.user_id)""", sql=f"""
SELECT event_id, {e4_sql("CASE WHEN alpha = 0 THEN v ELSE " + unit_sql("list_transform(list_zip(v, p), lambda z: z[1] * (1 - alpha) + z[2] * alpha)") + " END")} AS next_e4
FROM pairs""")
def _(spark, d):
    vectors = A.product_vectors(spark, d)
    current = vectors.select(F.col("product_id").alias("user_id"), F.col("product_vector").alias("current"))
    rows = A.user_actions(spark, d).join(vectors, "product_id").join(current, "user_id")
    step = FV.ema_step(F.col("current"), F.col("product_vector"), F.col("alpha"))
    return rows.withColumn("alpha", FA.action_alpha(F.col("action_type"))).select("event_id", e4(step).alias("next_e4"))


@query("knn_score", ACTIONS, VECTORS, sql="""
SELECT event_id, round((1 + list_cosine_similarity(CAST(a.product_vector AS DOUBLE[]), CAST(b.product_vector AS DOUBLE[]))) / 2, 6) AS score
FROM ua JOIN vectors a ON a.product_id = ua.product_id JOIN vectors b ON b.product_id = ua.user_id""")
def _(spark, d):
    vectors = A.product_vectors(spark, d)
    other = vectors.select(F.col("product_id").alias("user_id"), F.col("product_vector").alias("other"))
    rows = A.user_actions(spark, d).join(vectors, "product_id").join(other, "user_id")
    return rows.select("event_id", F.round(FV.knn_score(F.col("product_vector"), F.col("other")), 6).alias("score"))


@query("product_text", PRODUCTS, sql="""
SELECT product_id, concat('passage: ', concat_ws(' ', product_name, category, description)) AS text,
  concat('passage: ', concat_ws(' ', product_name, category, brand, substr(description, 1, 200))) AS text_with_brand,
  concat('query: ', product_name) AS query_text FROM goods""")
def _(spark, d):
    c = F.col
    return A.products(spark, d).select(
        "product_id", FT.product_text(c("product_name"), c("category"), c("description")).alias("text"),
        FT.product_text_with_brand(c("product_name"), c("category"), c("brand"), c("description")).alias("text_with_brand"),
        FT.query_text(c("product_name")).alias("query_text"))


@query("product_key", PRODUCTS, sql="""
SELECT product_id, printf('PROD-%s-%05d', substr(category, 1, 3), product_id) AS product_key,
  printf('USER-%06d', product_id) AS user_key FROM goods""")
def _(spark, d):
    return A.products(spark, d).select(
        "product_id", FT.product_key(F.col("category"), F.col("product_id")).alias("product_key"),
        FT.user_key(F.col("product_id")).alias("user_key"))


@query("kst_day", ACTIONS, sql="SELECT event_id, CAST(ts + INTERVAL 9 HOUR AS DATE) AS day FROM ua")
def _(spark, d):
    return A.user_actions(spark, d).select("event_id", FA.notification_day(F.col("ts")).alias("day"))
