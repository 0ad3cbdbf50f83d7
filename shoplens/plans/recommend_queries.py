"""Queries over taste vectors and recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.operators import preferences as P
from shoplens.operators import recommend, reports
from shoplens.operators.tables import latest_per_key
from shoplens.operators.vectorize import vectorize_catalog
from shoplens.plans.action_queries import e4, e4_sql
from shoplens.plans.registry import (
    ACTIONS, AS_OF_SQL, CATALOG, CATEGORISED, DIMS, FOLD, PRODUCTS, VECTORS, VIEWED, knn_sql, popular_sql, query, shown,
    unit_sql)
from shoplens.session import durable
from shoplens.sources import adapters as A

BASE = (ACTIONS, PRODUCTS, VECTORS, CATALOG, FOLD, VIEWED)
RANKED = "user_id, product_id, product_name, category, CAST(price AS DOUBLE) AS price, score, rank"
TOP = 10


def taste(spark, d):
    """Taste vectors of all users. Written once, as several branches of a plan read them."""
    return durable(P.preference_fold(A.user_actions(spark, d), A.product_vectors(spark, d), DIMS))


def recent_taste(spark, d):
    """Stored taste of the users whose last action is recent; the others are cold."""
    actions = A.user_actions(spark, d)
    warm = actions.groupBy("user_id").agg(F.max("ts").alias("t")).filter(
        F.col("t") >= A.as_of() - F.expr("INTERVAL 1 DAY")).select("user_id")
    return taste(spark, d).join(warm, "user_id", "left_semi")


WARM = f"""
warm AS (SELECT prefs.* FROM prefs WHERE user_id IN (
  SELECT user_id FROM ua GROUP BY user_id HAVING max(ts) >= {AS_OF_SQL} - INTERVAL 1 DAY))"""


@query("attach_vectors", ACTIONS, VECTORS, sql=f"""
SELECT event_id, user_id, product_id, coalesce(len(product_vector) = 64, false) = false AS skipped,
  {e4_sql('CAST(product_vector AS DOUBLE[])')} AS vector_e4 FROM ua LEFT JOIN vectors USING (product_id)""")
def _(spark, d):
    rows = P.attach_vectors(A.user_actions(spark, d), A.product_vectors(spark, d), DIMS)
    return rows.select("event_id", "user_id", "product_id", "skipped",
                       e4(F.col("product_vector").cast("array<double>")).alias("vector_e4"))


@query("preference_fold", ACTIONS, VECTORS, FOLD,
       sql=f"SELECT user_id, action_count, {e4_sql('preference_vector')} AS vector_e4 FROM prefs")
def _(spark, d):
    folded = P.preference_fold(A.user_actions(spark, d), A.product_vectors(spark, d), DIMS)
    return folded.select("user_id", "action_count", e4(F.col("preference_vector")).alias("vector_e4"))


LOOKUPS = f"""
bought AS (SELECT user_id, product_id, ts, event_id, count(*) OVER (PARTITION BY user_id) AS n FROM ua WHERE action_type = 'PURCHASE'
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
looked AS (SELECT user_id, product_id FROM ua WHERE action_type = 'VIEW' AND ts < {AS_OF_SQL} - INTERVAL 20 DAY
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
main AS (SELECT user_id, product_vector, n FROM bought JOIN vectors USING (product_id) WHERE ts > {AS_OF_SQL} - INTERVAL 24 HOUR),
backup AS (SELECT user_id, product_vector FROM looked JOIN vectors USING (product_id))"""


@query("preference_with_fallback", ACTIONS, VECTORS, LOOKUPS, sql=f"""
SELECT u.user_id, CASE WHEN m.n IS NOT NULL THEN m.n WHEN b.user_id IS NOT NULL THEN 1 END AS action_count,
  CASE WHEN m.user_id IS NOT NULL THEN 'primary' WHEN b.user_id IS NOT NULL THEN 'backup' ELSE 'none' END AS source,
  {e4_sql('CAST(coalesce(m.product_vector, b.product_vector) AS DOUBLE[])')} AS vector_e4
FROM (SELECT DISTINCT user_id FROM ua) u LEFT JOIN main m USING (user_id) LEFT JOIN backup b USING (user_id)""")
def _(spark, d):
    actions, vectors = A.user_actions(spark, d), A.product_vectors(spark, d)
    newest = F.max_by(F.struct("product_id", "ts"), F.struct("ts", "event_id")).alias("r")
    bought = (actions.filter("action_type = 'PURCHASE'").groupBy("user_id").agg(newest, F.count("*").alias("action_count"))
              .select("user_id", "r.*", "action_count").join(vectors, "product_id")
              .select("user_id", F.col("product_vector").alias("preference_vector"), "action_count",
                      F.col("ts").alias("updated_at")))
    old = (F.col("action_type") == "VIEW") & (F.col("ts") < A.as_of() - F.expr("INTERVAL 20 DAYS"))
    backup = (actions.filter(old).groupBy("user_id").agg(newest).select("user_id", "r.product_id")
              .join(vectors, "product_id").select("user_id", F.col("product_vector").alias("preference_vector"),
                                                  F.lit(None).cast("bigint").alias("action_count")))
    found = P.preference_with_fallback(actions.select("user_id").distinct(), bought, backup, A.as_of())
    return found.select("user_id", "action_count", "source",
                        e4(F.col("preference_vector").cast("array<double>")).alias("vector_e4"))


VERSIONS = """
hourly AS (SELECT user_id, action_type, event_id AS payload, epoch_us(ts) // 3600000000 AS updated_at, event_id AS seq FROM ua),
held AS (SELECT user_id, payload, updated_at FROM hourly WHERE action_type = 'PURCHASE'
         QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, seq DESC) = 1)"""


@query("upsert_preference_versioned", ACTIONS, VERSIONS, sql="""
SELECT user_id, payload, updated_at FROM (
  SELECT user_id, payload, updated_at, 1 AS old, 0 AS seq FROM held
  UNION ALL SELECT user_id, payload, updated_at, 0, seq FROM hourly WHERE action_type = 'CLICK')
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, old DESC, seq) = 1""")
def _(spark, d):
    hourly = A.user_actions(spark, d).select(
        "user_id", "action_type", F.col("event_id").alias("payload"),
        F.call_function("div", F.unix_seconds("ts"), F.lit(3600)).alias("updated_at"), F.col("event_id").alias("seq"))
    held = latest_per_key(hourly.filter("action_type = 'PURCHASE'"), "user_id", ["updated_at", "seq"]).select(
        "user_id", "payload", "updated_at")
    return P.newest_version(held, hourly.filter("action_type = 'CLICK'"), "user_id", "updated_at")


@query("latest_version", ACTIONS, sql="""
SELECT user_id, event_id, action_type, product_id FROM ua
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, d):
    rows = A.user_actions(spark, d).select("user_id", "event_id", "action_type", "product_id", "ts")
    return latest_per_key(rows, "user_id", ["ts", "event_id"]).drop("ts")


@query("knn_recommend", *BASE, knn_sql("prefs", TOP), sql=f"SELECT {RANKED} FROM knn")
def _(spark, d):
    viewed = recommend.recent_viewed(A.user_actions(spark, d), A.as_of())
    return shown(recommend.knn_recommend(taste(spark, d), A.catalog(spark, d), TOP, DIMS, viewed=viewed))


@query("knn_recommend_blocks", *BASE, knn_sql("prefs", TOP), sql=f"SELECT {RANKED} FROM knn")
def _(spark, d):
    """The same with blocks so small that users are routed to them."""
    viewed = recommend.recent_viewed(A.user_actions(spark, d), A.as_of())
    return shown(recommend.knn_recommend(taste(spark, d), A.catalog(spark, d), TOP, DIMS, viewed=viewed, block_rows=32))


@query("knn_recommend_category", *BASE, knn_sql("prefs", 50, "g.category = 'SMALL'", exclude=False),
       sql=f"SELECT {RANKED} FROM knn")
def _(spark, d):
    # A limit above the maximum is lowered to it.
    return shown(recommend.knn_recommend(taste(spark, d), A.catalog(spark, d), 80, DIMS, category="SMALL"))


def everyone(spark, d, limit=TOP, users=None, **kw):
    goods = A.catalog(spark, d)
    actions = A.user_actions(spark, d)
    if kw.get("category"):
        actions = A.categorised(actions, goods)
    users = (actions if users is None else users).select("user_id").distinct()
    return recommend.recommend_all(users, recent_taste(spark, d), goods, actions,
                                   A.as_of(), limit, DIMS, **kw)


ALL_SQL = f"""
everyone AS (SELECT user_id, product_id, product_name, category, price, score, rank, 'knn' AS strategy FROM knn
  UNION ALL SELECT user_id, product_id, product_name, category, price, p.score, p.rank, 'popularity'
  FROM (SELECT DISTINCT user_id FROM ua WHERE user_id NOT IN (SELECT user_id FROM warm)) c, popular p)"""
EVERYONE = (*BASE, WARM, knn_sql("warm", TOP), popular_sql(TOP), ALL_SQL)


@query("recommend_all", *EVERYONE, sql=f"SELECT {RANKED}, strategy FROM everyone")
def recommend_all(spark, d):
    return shown(everyone(spark, d))


@query("recommend_all_category", *BASE, CATEGORISED, WARM, knn_sql("warm", TOP, "g.category = 'SMALL'"), f"""
tiers AS (SELECT 1 AS tier, product_id, count(*) AS n FROM ca WHERE category = 'SMALL' AND action_type = 'PURCHASE'
            AND ts >= {AS_OF_SQL} - INTERVAL 7 DAY AND ts <= {AS_OF_SQL} GROUP BY ALL
          UNION ALL SELECT 2, product_id, count(*) FROM ca WHERE category = 'SMALL' AND action_type IN ('VIEW', 'CLICK')
            AND ts >= {AS_OF_SQL} - INTERVAL 7 DAY AND ts <= {AS_OF_SQL} GROUP BY ALL
          UNION ALL SELECT 3, product_id, created_at_ms FROM goods WHERE category = 'SMALL'),
best AS (SELECT *, row_number() OVER (ORDER BY n DESC, product_id) AS rank FROM tiers WHERE tier = (SELECT min(tier) FROM tiers))""",
       sql=f"""
SELECT {RANKED}, 'knn' AS strategy FROM knn
UNION ALL SELECT user_id, product_id, product_name, category, CAST(price AS DOUBLE), 0.0, rank, 'category_best'
FROM (SELECT DISTINCT user_id FROM ua WHERE user_id NOT IN (SELECT user_id FROM warm)) c, best JOIN goods USING (product_id)
WHERE rank <= {TOP}""")
def _(spark, d):
    return shown(everyone(spark, d, category="SMALL"))


@query("strategy_mix", *EVERYONE,
       sql="SELECT strategy, count(*) AS products, count(DISTINCT user_id) AS users FROM everyone GROUP BY strategy")
def _(spark, d):
    return reports.strategy_mix(everyone(spark, d))


@query("category_hit_rate", *EVERYONE, CATEGORISED, """
clicked AS (SELECT user_id, category, count(*) AS n FROM ca WHERE action_type = 'CLICK' AND category IS NOT NULL GROUP BY ALL),
dominant AS (SELECT user_id, category AS dominant FROM clicked
             QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category) = 1)""", sql="""
SELECT user_id, round(avg((category = dominant)::INT), 6) AS hit_rate, avg((category = dominant)::INT) >= 0.7 AS on_target
FROM everyone JOIN dominant USING (user_id) GROUP BY user_id""")
def _(spark, d):
    actions = A.categorised(A.user_actions(spark, d), A.products(spark, d))
    return reports.category_hit_rate(everyone(spark, d), actions).withColumn("hit_rate", F.round("hit_rate", 6))


@query("vectorize_catalog", PRODUCTS, """
words AS (SELECT product_id, unnest(string_split(lower(concat('passage: ', concat_ws(' ', product_name, category, description))), ' ')) AS word FROM goods),
hashed AS (SELECT product_id, CAST(concat('0x', substr(md5(word), 1, 8)) AS BIGINT) AS h FROM words),
entries AS (SELECT product_id, (h >> 1) % 64 AS i, CAST(sum(CASE WHEN h & 1 = 1 THEN 1 ELSE -1 END) AS DOUBLE) AS x FROM hashed GROUP BY ALL),
filled AS (SELECT product_id, list(coalesce(x, 0) ORDER BY i) AS v
           FROM (SELECT product_id, unnest(range(64)) AS i FROM goods) LEFT JOIN entries USING (product_id, i) GROUP BY product_id)""",
       sql=f"SELECT product_id, {e4_sql('CAST(CAST(' + unit_sql('v') + ' AS FLOAT[]) AS DOUBLE[])')} AS vector_e4 FROM filled")
def _(spark, d):
    rows = vectorize_catalog(A.products(spark, d), DIMS)
    return rows.select("product_id", e4(F.col("product_vector").cast("array<double>")).alias("vector_e4"))
