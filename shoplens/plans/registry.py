"""Registry of named queries, each with the SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Settings of the domain on the given tables.
DIMS = 64
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
# The given events hold no cart action, so clicks stand for it where restocks need one.
CART_ACTIONS = ["CLICK"]


def query(name: str, *ctes: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `ctes` are the named frames its SQL starts from."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(prepare(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            recursive = "RECURSIVE " if any("/*recursive*/" in c for c in ctes) or "/*recursive*/" in sql else ""
            head = f"WITH {recursive}{', '.join(ctes)} " if ctes else ""
            ORACLES[name] = (head + sql).strip()
        return fn

    return register


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Scores rounded for comparison across engines; ranking has used the whole score."""
    return df.withColumn("score", F.round("score", digits))


_WIDER = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double", "timestamp": "timestamp_ntz"}


def present(df: DataFrame) -> DataFrame:
    """Widest type of each kind, so that results compare across engines."""
    return df.select(*[
        F.col(f.name).cast(_WIDER[f.dataType.simpleString()]).alias(f.name)
        if f.dataType.simpleString() in _WIDER else F.col(f.name) for f in df.schema.fields])


# Named frames of the SQL side, equal to `shoplens.sources.adapters`.
ACTIONS = """
ua AS (SELECT concat('T', event_id) AS trace_id, event_id, user_id,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS product_id,
         upper(event_type) AS action_type, ts, value FROM events)"""
PRODUCTS = """
goods AS (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         CAST(p_retailprice AS FLOAT) AS price, CAST(p_size % 5 AS BIGINT) AS stock,
         concat_ws(' ', 'a', p_name, 'by', p_brand) AS description,
         1672531200000 + p_partkey * 60000 AS created_at_ms FROM part)"""
VECTORS = "vectors AS (SELECT vec_id AS product_id, embedding AS product_vector FROM embeddings)"
CATALOG = "full_catalog AS (SELECT goods.*, product_vector FROM goods LEFT JOIN vectors USING (product_id))"
CATEGORISED = "ca AS (SELECT ua.*, category FROM ua LEFT JOIN goods USING (product_id))"
INVENTORY = """
inv AS (SELECT concat('I', event_id) AS inventory_event_id, event_id AS seq,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS product_id,
         CASE event_type WHEN 'purchase' THEN 'PRICE_CHANGE' WHEN 'click' THEN 'STOCK_CHANGE' ELSE 'PRODUCT_UPDATE' END AS event_type,
         CASE WHEN event_type = 'purchase' THEN CAST(value * (90 + event_id % 40) / 100 AS FLOAT) END AS previous_price,
         CASE WHEN event_type = 'purchase' THEN CAST(value AS FLOAT) END AS current_price,
         CASE WHEN event_type = 'click' THEN event_id % 3 END AS previous_stock,
         CASE WHEN event_type = 'click' THEN event_id % 4 END AS current_stock, ts FROM events)"""
DROPS = """
priced AS (SELECT *, CASE WHEN previous_price > 0 AND current_price >= 0 THEN CAST(trunc(
             CAST(CAST(previous_price - current_price AS FLOAT) / previous_price AS FLOAT) * CAST(100 AS FLOAT)) AS BIGINT) END AS drop_percentage
           FROM inv WHERE event_type = 'PRICE_CHANGE'),
drops AS (SELECT * FROM priced WHERE drop_percentage >= 10)"""
RESTOCKS = """
restocks AS (SELECT * FROM inv WHERE event_type = 'STOCK_CHANGE' AND previous_stock = 0 AND current_stock > 0)"""
ATTEMPTS = """
attempts AS (SELECT concat('A', event_id) AS attempt_id, user_id,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 10 AS product_id,
         CASE event_type WHEN 'purchase' THEN 'PRICE_DROP' WHEN 'click' THEN 'BACK_IN_STOCK' ELSE 'RECOMMENDATION' END AS notification_type,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id * 20) AS ts, event_id AS seq FROM events)"""
NOTIFICATIONS = """
notes AS (SELECT concat('N', event_id // 2) AS notification_id, event_id, user_id,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS product_id,
         CASE event_type WHEN 'purchase' THEN 'PRICE_DROP' WHEN 'click' THEN 'BACK_IN_STOCK' ELSE 'RECOMMENDATION' END AS notification_type,
         CASE event_type WHEN 'error' THEN ['FAX'] WHEN 'click' THEN ['PUSH', 'SMS'] ELSE ['PUSH', 'IN_APP'] END AS channels,
         ts FROM events)"""
SPANS = """
spans AS (SELECT concat('TR', event_id // 8) AS trace_id, event_id AS span_id, event_id % 8 AS position,
         CASE WHEN event_id % 8 = 0 THEN NULL WHEN event_id % 8 = 7 THEN -event_id
              ELSE event_id - event_id % 8 + (event_id % 8 - 1) // 2 END AS parent_id,
         CASE WHEN regexp_extract(props, '([0-9]+)', 1) = '11' THEN concat('orders.DLQ ', event_type) ELSE event_type END AS operation_name,
         CASE WHEN event_type = 'error' THEN 'unknown' ELSE concat(event_type, '-service') END AS service_name,
         CAST(1706000000000000 + (event_id // 8) * 1000000 + (event_id % 8) * CAST(floor(value * 100) AS BIGINT) AS BIGINT) AS start_us,
         CAST(floor(value * 1000) AS BIGINT) AS duration_us,
         event_type = 'error' OR value > 480 AS has_error,
         regexp_extract(props, '([0-9]+)', 1) IN ('7', '11') AS is_dlq,
         CASE WHEN event_type = 'error' THEN concat('code ', regexp_extract(props, '([0-9]+)', 1)) END AS message
       FROM events)"""
ANOMALIES = """
stored AS (SELECT concat('TR', event_id // 8) AS trace_id, event_id,
         CASE WHEN event_type = 'error' THEN 'ERROR_SPAN' WHEN value > 250 THEN 'SLOW_TRACE' ELSE 'unheard-of' END AS type,
         CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'odd' END AS severity,
         concat(event_type, '-service') AS service_name, event_type = 'signup' AS is_bookmark,
         CAST(floor(value) AS BIGINT) AS duration_ms, concat('note ', event_id % 7) AS note, ts AS detected_at, ts AS created_at
       FROM events)"""
ALPHA = """CASE upper(action_type) WHEN 'PURCHASE' THEN 0.5::DOUBLE WHEN 'ADD_TO_CART' THEN 0.3 WHEN 'CLICK' THEN 0.3
           WHEN 'SEARCH' THEN 0.2 WHEN 'VIEW' THEN 0.1 WHEN 'WISHLIST' THEN 0.1 ELSE 0.0 END"""


def unit_sql(vector: str) -> str:
    return f"list_transform({vector}, lambda x: x / sqrt(list_sum(list_transform({vector}, lambda y: y * y))))"


FOLD = f"""/*recursive*/
steps AS (SELECT user_id, {ALPHA} AS alpha, CAST(product_vector AS DOUBLE[]) AS p,
            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
          FROM ua JOIN vectors USING (product_id)),
fold AS (SELECT user_id, rn, {unit_sql('p')} AS v FROM steps WHERE rn = 1
         UNION ALL
         SELECT s.user_id, s.rn, CASE WHEN s.alpha = 0 THEN f.v ELSE
           {unit_sql('list_transform(list_zip(f.v, s.p), lambda z: z[1] * (1 - s.alpha) + z[2] * s.alpha)')} END
         FROM fold f JOIN steps s ON s.user_id = f.user_id AND s.rn = f.rn + 1),
prefs AS (SELECT user_id, arg_max(v, rn) AS preference_vector, max(rn) AS action_count FROM fold GROUP BY user_id)"""
VIEWED = f"""
viewed AS (SELECT user_id, product_id, min(rank) AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM ua
             WHERE action_type IN ('VIEW', 'CLICK') AND ts >= {AS_OF_SQL} - INTERVAL 7 DAY AND ts <= {AS_OF_SQL})
           WHERE rank <= 100 GROUP BY user_id, product_id)"""
ACTIVE = f"""
active AS (SELECT user_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, user_id) AS rank FROM ua
           WHERE ts >= {AS_OF_SQL} - INTERVAL 7 DAY AND ts <= {AS_OF_SQL} GROUP BY user_id
           QUALIFY rank <= 10000)"""


def knn_sql(users: str, k: int, condition: str = "true", exclude: bool = True) -> str:
    """Exact nearest products by brute force over `users(user_id, preference_vector)`."""
    unseen = ("AND NOT EXISTS (SELECT 1 FROM viewed w WHERE w.user_id = u.user_id AND w.product_id = g.product_id)"
              if exclude else "")
    return f"""
near AS (SELECT u.user_id, g.product_id, g.product_name, g.category, g.price,
           (1 + list_cosine_similarity(u.preference_vector, CAST(g.product_vector AS DOUBLE[]))) / 2 AS raw
         FROM {users} u, full_catalog g
         WHERE g.stock > 0 AND len(g.product_vector) = 64 AND {condition} {unseen}),
knn AS (SELECT *, round(raw, 6) AS score, row_number() OVER (PARTITION BY user_id ORDER BY raw DESC, product_id) AS rank FROM near
        QUALIFY rank <= {k})"""


def popular_sql(limit: int) -> str:
    span = f"ts >= {AS_OF_SQL} - INTERVAL 7 DAY AND ts <= {AS_OF_SQL}"
    return f"""
tiers AS (SELECT 1 AS tier, product_id, count(*) AS n FROM ua WHERE action_type = 'PURCHASE' AND {span} GROUP BY ALL
          UNION ALL SELECT 2, product_id, count(*) FROM ua WHERE action_type IN ('VIEW', 'CLICK') AND {span} GROUP BY ALL
          UNION ALL SELECT 3, product_id, created_at_ms FROM goods),
chosen AS (SELECT *, row_number() OVER (ORDER BY n DESC, product_id) AS rank FROM tiers
           WHERE tier = (SELECT min(tier) FROM tiers)),
popular AS (SELECT product_id, product_name, category, price, rank, tier, 0.0::DOUBLE AS score
            FROM chosen JOIN goods USING (product_id) WHERE rank <= {limit})"""


def gate_sql(source: str = "attempts") -> str:
    """Daily cap, then the greedy one-hour gate."""
    return f"""/*recursive*/
numbered AS (SELECT *, CAST(ts + INTERVAL 9 HOUR AS DATE) AS day,
               row_number() OVER (PARTITION BY user_id, CAST(ts + INTERVAL 9 HOUR AS DATE) ORDER BY ts, seq) AS attempt_no FROM {source}),
capped AS (SELECT * FROM numbered WHERE attempt_no <= 10),
{duplicates_sql('capped')}"""


def duplicates_sql(source: str) -> str:
    return f"""/*recursive*/
queue AS (SELECT *, row_number() OVER (PARTITION BY user_id, product_id, notification_type ORDER BY ts, seq) AS rn FROM {source}),
gate AS (SELECT attempt_id, user_id, product_id, notification_type, ts, seq, rn, ts AS last, true AS ok FROM queue WHERE rn = 1
         UNION ALL
         SELECT q.attempt_id, q.user_id, q.product_id, q.notification_type, q.ts, q.seq, q.rn,
           CASE WHEN q.ts >= g.last + INTERVAL 1 HOUR THEN q.ts ELSE g.last END, q.ts >= g.last + INTERVAL 1 HOUR
         FROM gate g JOIN queue q ON q.user_id = g.user_id AND q.product_id = g.product_id
           AND q.notification_type = g.notification_type AND q.rn = g.rn + 1),
admitted AS (SELECT * FROM gate WHERE ok)"""


def targets_sql(events: str, types: str, days: int) -> str:
    return f"""
matches AS (SELECT e.inventory_event_id, a.user_id, count(*) AS n FROM {events} e JOIN ua a ON a.product_id = e.product_id
            AND a.action_type IN ({types}) AND a.ts <= e.ts AND a.ts >= e.ts - INTERVAL {days} DAY GROUP BY ALL),
targets AS (SELECT *, row_number() OVER (PARTITION BY inventory_event_id ORDER BY n DESC, user_id) AS rank FROM matches
            QUALIFY rank <= 10000)"""


def target_attempts_sql(events: str, kind: str) -> str:
    return f"""
attempts AS (SELECT concat_ws('|', inventory_event_id, user_id) AS attempt_id, inventory_event_id, user_id, product_id,
             '{kind}' AS notification_type, ts, seq * 2147483648 + rank AS seq, rank FROM targets JOIN {events} USING (inventory_event_id))"""
