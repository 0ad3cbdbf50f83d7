"""Queries from inventory events to notifications, gates and delivery."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.functions import actions as FA
from shoplens.functions import text as FT
from shoplens.operators import gates, interest, notify, reports
from shoplens.operators.preferences import attach_vectors
from shoplens.plans.recommend_queries import EVERYONE, everyone
from shoplens.plans.registry import (
    ACTIONS, ACTIVE, AS_OF_SQL, ATTEMPTS, CART_ACTIONS, DIMS, DROPS, INVENTORY, NOTIFICATIONS, PRODUCTS, RESTOCKS, VECTORS,
    duplicates_sql, gate_sql, query, target_attempts_sql, targets_sql)
from shoplens.schemas import ACTION_TYPES
from shoplens.session import durable
from shoplens.sources import adapters as A

DROP_TYPES = "'VIEW', 'CLICK', 'ADD_TO_CART'"
CART_TYPES = "'CLICK'"
MESSAGE = "notification_id, user_id, product_id, notification_type, title, body, channels, priority"


def flat(messages):
    """Messages with the channel list and the payload as text."""
    data = F.array_join(F.transform(F.array_sort(F.map_entries("data")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return messages.withColumn("channels", F.array_join("channels", ",")).withColumn("data", data).select(
        *[c.strip() for c in MESSAGE.split(",")], "data")


@query("read_inventory_events", INVENTORY, sql="""
SELECT inventory_event_id, product_id, event_type, CAST(previous_price AS DOUBLE) AS previous_price,
  CAST(current_price AS DOUBLE) AS current_price, previous_stock, current_stock, ts,
  CASE event_type WHEN 'PRICE_CHANGE' THEN 'price' WHEN 'STOCK_CHANGE' THEN 'restock' ELSE 'ignored' END AS route FROM inv""")
def _(spark, d):
    events = A.inventory_events(spark, d)
    tagged = [notify.price_events(events).withColumn("route", F.lit("price")),
              notify.stock_events(events).withColumn("route", F.lit("restock")),
              events.filter(~F.col("event_type").isin("PRICE_CHANGE", "STOCK_CHANGE")).withColumn("route", F.lit("ignored"))]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).drop("seq")


@query("drop_percentage", INVENTORY, DROPS,
       sql="SELECT inventory_event_id, drop_percentage, coalesce(drop_percentage >= 10, false) AS fires FROM priced")
def _(spark, d):
    p, c = F.col("previous_price"), F.col("current_price")
    return notify.price_events(A.inventory_events(spark, d)).select(
        "inventory_event_id", FA.drop_percentage(p, c).alias("drop_percentage"), FA.is_price_drop(p, c).alias("fires"))


@query("is_restock", INVENTORY, sql="""
SELECT inventory_event_id, coalesce(previous_stock = 0 AND current_stock > 0, false) AS restocked FROM inv""")
def _(spark, d):
    return A.inventory_events(spark, d).select(
        "inventory_event_id", FA.is_restock(F.col("previous_stock"), F.col("current_stock")).alias("restocked"))


@query("price_drop_targets", ACTIONS, INVENTORY, DROPS, targets_sql("drops", DROP_TYPES, 30),
       sql="SELECT inventory_event_id, user_id, n, rank FROM targets")
def _(spark, d):
    return interest.price_drop_targets(notify.price_drops(A.inventory_events(spark, d)), A.user_actions(spark, d), interest.MAX_USERS)


@query("restock_targets", ACTIONS, INVENTORY, RESTOCKS, targets_sql("restocks", CART_TYPES, 7),
       sql="SELECT inventory_event_id, user_id, n, rank FROM targets")
def _(spark, d):
    return interest.restock_targets(notify.restocks(A.inventory_events(spark, d)), A.user_actions(spark, d), CART_ACTIONS,
                                    interest.MAX_USERS)


@query("attach_product_name", ACTIONS, PRODUCTS, sql=f"""
SELECT event_id, coalesce(product_name, '{FT.UNKNOWN_PRODUCT}') AS product_name
FROM ua LEFT JOIN goods ON goods.product_id = ua.product_id * 50""")
def _(spark, d):
    # Widened ids, so that some are not in the catalogue.
    rows = A.user_actions(spark, d).select("event_id", (F.col("product_id") * 50).alias("product_id"))
    return notify.attach_product_name(rows, A.products(spark, d)).select("event_id", "product_name")


@query("daily_cap", ATTEMPTS, gate_sql(), sql="""
SELECT attempt_id, user_id, day, attempt_no <= 10 AS allowed, CASE WHEN attempt_no <= 10 THEN attempt_no END AS attempt_no FROM numbered""")
def _(spark, d):
    return gates.daily_cap(A.attempts(spark, d)).select("attempt_id", "user_id", "day", "allowed", "attempt_no")


@query("duplicate_gate", ATTEMPTS, duplicates_sql("attempts"),
       sql="SELECT attempt_id, user_id, product_id, notification_type, ts, seq FROM admitted")
def _(spark, d):
    return gates.duplicate_gate(A.attempts(spark, d))


@query("can_send", ATTEMPTS, gate_sql(), sql="SELECT attempt_id, user_id, product_id, notification_type, ts, seq FROM admitted")
def _(spark, d):
    return gates.can_send(A.attempts(spark, d)).select("attempt_id", "user_id", "product_id", "notification_type", "ts", "seq")


@query("detection_counts", ATTEMPTS, gate_sql(), sql="""
SELECT notification_type, attempts, attempts - coalesce(capped, 0) AS daily_blocked,
  coalesce(capped, 0) - coalesce(sent, 0) AS duplicate_blocked, coalesce(sent, 0) AS sent
FROM (SELECT notification_type, count(*) AS attempts FROM attempts GROUP BY 1)
LEFT JOIN (SELECT notification_type, count(*) AS capped FROM capped GROUP BY 1) USING (notification_type)
LEFT JOIN (SELECT notification_type, count(*) AS sent FROM admitted GROUP BY 1) USING (notification_type)""")
def _(spark, d):
    attempts = A.attempts(spark, d)
    return reports.detection_counts(attempts, gates.within_daily_cap(attempts), gates.can_send(attempts))


PRICE_MESSAGES = f"""
messages AS (SELECT sha256(concat_ws('|', a.inventory_event_id, a.user_id, 'PRICE_DROP')) AS notification_id, a.user_id, a.product_id,
    'PRICE_DROP' AS notification_type, '{FT.TITLES["PRICE_DROP"]}' AS title,
    printf('{FT.PRICE_DROP_BODY}', coalesce(product_name, '{FT.UNKNOWN_PRODUCT}'), d.drop_percentage) AS body,
    'PUSH,IN_APP' AS channels, 'HIGH' AS priority, d.drop_percentage
  FROM admitted g JOIN attempts a USING (attempt_id) JOIN drops d USING (inventory_event_id)
  LEFT JOIN goods ON goods.product_id = a.product_id)"""


@query("detect_price_drop", ACTIONS, PRODUCTS, INVENTORY, DROPS, targets_sql("drops", DROP_TYPES, 30),
       target_attempts_sql("drops", "PRICE_DROP"), gate_sql(), PRICE_MESSAGES,
       sql=f"SELECT {MESSAGE}, drop_percentage FROM messages")
def _(spark, d):
    found = notify.detect_price_drop(A.inventory_events(spark, d), A.user_actions(spark, d), A.products(spark, d),
                                     interest.MAX_USERS)
    # The float texts of the payload are covered by `notification_data`; here only the percentage is compared.
    drop = F.col("data")["dropPercentage"].cast("bigint").alias("drop_percentage")
    return found.withColumn("channels", F.array_join("channels", ",")).select(
        *[c.strip() for c in MESSAGE.split(",")], drop)


@query("detect_restock", ACTIONS, PRODUCTS, INVENTORY, RESTOCKS, targets_sql("restocks", CART_TYPES, 7),
       target_attempts_sql("restocks", "BACK_IN_STOCK"), gate_sql(), f"""
messages AS (SELECT sha256(concat_ws('|', a.inventory_event_id, a.user_id, 'BACK_IN_STOCK')) AS notification_id, a.user_id, a.product_id,
    'BACK_IN_STOCK' AS notification_type, '{FT.TITLES["BACK_IN_STOCK"]}' AS title,
    printf('{FT.BACK_IN_STOCK_BODY}', coalesce(product_name, '{FT.UNKNOWN_PRODUCT}')) AS body,
    'PUSH,SMS' AS channels, 'HIGH' AS priority, concat('currentStock=', r.current_stock) AS data
  FROM admitted g JOIN attempts a USING (attempt_id) JOIN restocks r USING (inventory_event_id)
  LEFT JOIN goods ON goods.product_id = a.product_id)""", sql=f"SELECT {MESSAGE}, data FROM messages")
def _(spark, d):
    return flat(notify.detect_restock(A.inventory_events(spark, d), A.user_actions(spark, d), A.products(spark, d),
                                      CART_ACTIONS, interest.MAX_USERS))


@query("send_schedule", ACTIONS, ACTIVE,
       sql="SELECT user_id, rank, (rank - 1) // 100 AS chunk, (rank - 1) // 100 * 50 AS delay_ms FROM active")
def _(spark, d):
    ranked = interest.active_users(A.user_actions(spark, d), A.as_of(), limit=interest.MAX_USERS)
    return notify.send_schedule(ranked).select("user_id", "rank", "chunk", "delay_ms")


@query("notification_text", INVENTORY, DROPS, RESTOCKS, PRODUCTS, f"""
named AS (SELECT inv.*, coalesce(product_name, '{FT.UNKNOWN_PRODUCT}') AS name, drop_percentage FROM inv
          LEFT JOIN goods USING (product_id) LEFT JOIN (SELECT inventory_event_id, drop_percentage FROM drops) USING (inventory_event_id))""",
       sql=f"""
SELECT inventory_event_id, '{FT.TITLES["PRICE_DROP"]}' AS title, printf('{FT.PRICE_DROP_BODY}', name, drop_percentage) AS body
FROM named WHERE drop_percentage IS NOT NULL
UNION ALL SELECT inventory_event_id, '{FT.TITLES["BACK_IN_STOCK"]}', printf('{FT.BACK_IN_STOCK_BODY}', name)
FROM named WHERE inventory_event_id IN (SELECT inventory_event_id FROM restocks)""")
def _(spark, d):
    events, goods = A.inventory_events(spark, d), A.products(spark, d)
    drops = notify.attach_product_name(notify.price_drops(events), goods)
    back = notify.attach_product_name(notify.restocks(events), goods)
    return drops.select(
        "inventory_event_id", FT.title(F.lit("PRICE_DROP")).alias("title"),
        FT.price_drop_body(F.col("product_name"), F.col("drop_percentage")).alias("body")).unionByName(back.select(
            "inventory_event_id", FT.title(F.lit("BACK_IN_STOCK")).alias("title"),
            FT.back_in_stock_body(F.col("product_name")).alias("body")))


@query("notification_data", INVENTORY, DROPS, sql="""
SELECT inventory_event_id, CAST(previous_price AS VARCHAR) AS previous_price, CAST(current_price AS VARCHAR) AS current_price,
  CAST(drop_percentage AS VARCHAR) AS drop_percentage FROM drops""")
def _(spark, d):
    drops = notify.price_drops(A.inventory_events(spark, d))
    data = FT.price_drop_data(F.col("previous_price"), F.col("current_price"), F.col("drop_percentage"))
    return drops.select("inventory_event_id", data["previousPrice"].alias("previous_price"),
                        data["currentPrice"].alias("current_price"), data["dropPercentage"].alias("drop_percentage"))


@query("channel_counts", NOTIFICATIONS,
       sql="SELECT channel, count(*) AS n FROM (SELECT unnest(channels) AS channel FROM notes) GROUP BY channel")
def _(spark, d):
    return reports.channel_counts(notify.deliveries(A.notifications(spark, d)))


@query("deliver_and_record", NOTIFICATIONS, sql="""
SELECT notification_id, event_id, user_id, array_to_string(channels, ',') AS channels,
  CASE WHEN list_has_any(channels, ['FAX']) THEN 'FAILED' ELSE 'SENT' END AS status, ts + INTERVAL 1 SECOND AS sent_at FROM notes
QUALIFY row_number() OVER (PARTITION BY notification_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, d):
    from shoplens.operators.tables import latest_per_key

    sent = notify.delivery_history(A.notifications(spark, d), F.col("ts") + F.expr("INTERVAL 1 SECOND"))
    return latest_per_key(sent, "notification_id", ["ts", "event_id"]).select(
        "notification_id", "event_id", "user_id", F.array_join("channels", ",").alias("channels"), "status", "sent_at")


DAILY = f"""
attempts AS (SELECT concat_ws('|', 'daily', user_id) AS attempt_id, user_id, 'DAILY_RECOMMENDATION' AS product_id,
  'RECOMMENDATION' AS notification_type, {AS_OF_SQL} AS ts, rank AS seq, rank FROM active)"""


def _kind_sql(name: str, events: str, types: str, days: int, kind: str) -> tuple[str, str]:
    """Targets of one kind under names of their own, and their attempts."""
    targets = targets_sql(events, types, days).replace("matches", f"{name}_matches").replace("targets AS", f"{name}_targets AS")
    return targets, f"""
SELECT concat_ws('|', inventory_event_id, user_id) AS attempt_id, user_id, CAST(product_id AS VARCHAR) AS product_id,
  '{kind}' AS notification_type, ts, seq * 2147483648 + rank AS seq FROM {name}_targets JOIN {events} USING (inventory_event_id)"""


DROP_KIND, BACK_KIND = _kind_sql("drop", "drops", DROP_TYPES, 30, "PRICE_DROP"), _kind_sql("back", "restocks", CART_TYPES, 7, "BACK_IN_STOCK")


@query("send_all", ACTIONS, INVENTORY, DROPS, RESTOCKS, ACTIVE, DROP_KIND[0], BACK_KIND[0], f"""
attempts AS ({DROP_KIND[1]} UNION ALL {BACK_KIND[1]} UNION ALL
SELECT concat_ws('|', 'daily', user_id), user_id, 'DAILY_RECOMMENDATION', 'RECOMMENDATION', {AS_OF_SQL}, rank FROM active)""",
       gate_sql(), sql="SELECT attempt_id, user_id, product_id, notification_type, ts, seq FROM admitted")
def _(spark, d):
    return notify.send_all(A.inventory_events(spark, d), A.user_actions(spark, d), A.as_of(), CART_ACTIONS, interest.MAX_USERS)


INGEST_FUNNEL = f"""
ingested AS (SELECT count(*) AS processed, count(*) FILTER (known) AS indexed, count(*) FILTER (NOT known) AS failed,
    count(*) FILTER (known AND usable) AS preference_success, count(*) FILTER (known AND NOT usable) AS preference_skipped,
    count(*) FILTER (NOT known) AS dlq_sent
  FROM (SELECT action_type IN {tuple(ACTION_TYPES)} AS known, coalesce(len(product_vector) = {DIMS}, false) AS usable
        FROM ua LEFT JOIN vectors USING (product_id)))"""


@query("pipeline_funnel", ACTIONS, VECTORS, INVENTORY, DROPS, RESTOCKS, INGEST_FUNNEL, DROP_KIND[0], BACK_KIND[0],
       f"attempts AS ({DROP_KIND[1]} UNION ALL {BACK_KIND[1]})", gate_sql(), sql="""
SELECT ingested.*, (SELECT count(*) FROM drops) + (SELECT count(*) FROM restocks) AS detected,
  (SELECT count(*) FROM admitted) AS triggered, (SELECT count(*) FROM attempts) - (SELECT count(*) FROM admitted) AS rate_limited,
  (SELECT count(*) FROM admitted) AS sent, 0 AS send_failed, (SELECT count(*) FROM admitted) AS saved FROM ingested""")
def _(spark, d):
    """Both halves: what became of the actions, and of the messages that price drops and restocks led to."""
    actions = A.user_actions(spark, d)
    rows = attach_vectors(actions, A.product_vectors(spark, d), DIMS)
    known, skipped = F.col("action_type").isin(ACTION_TYPES), F.col("skipped")
    ingested = reports.processing_funnel(rows, {
        "processed": F.lit(True), "indexed": known, "failed": ~known, "preference_success": known & ~skipped,
        "preference_skipped": known & skipped, "dlq_sent": ~known})
    told = notify.notification_funnel(A.inventory_events(spark, d), actions, A.catalog(spark, d), CART_ACTIONS, interest.MAX_USERS)
    one = F.lit(1).alias("_one")
    return ingested.select("*", one).join(told.select("*", one), "_one").drop("_one")


DAILY_MESSAGES = f"""
lists AS (SELECT user_id, strategy, string_agg(product_id::VARCHAR, ',' ORDER BY rank) AS ids,
            string_agg(product_name, ', ' ORDER BY rank) AS names, arg_min(product_id, rank) AS product_id, count(*) AS n
          FROM everyone WHERE rank <= 3 GROUP BY ALL),
messages AS (SELECT user_id, lists.product_id, 'RECOMMENDATION' AS notification_type, '{FT.TITLES["RECOMMENDATION"]}' AS title,
    printf('{FT.RECOMMENDATION_BODY}', names) AS body, 'PUSH,IN_APP' AS channels, 'NORMAL' AS priority,
    concat('productCount=', n, ';productIds=', ids, ';strategy=', strategy) AS data
  FROM admitted JOIN lists USING (user_id))"""


def _daily(spark, d):
    actions = A.user_actions(spark, d)
    attempts = notify.daily_attempts(actions, A.as_of(), interest.MAX_USERS)
    # Only users whose attempt is admitted get recommendations computed.
    admitted = durable(gates.can_send(attempts))
    messages = notify.daily_recommendations(admitted, everyone(spark, d, notify.DAILY_PRODUCTS, users=admitted))
    return attempts, admitted, messages


@query("daily_recommendations", *EVERYONE, ACTIVE, DAILY, gate_sql(), DAILY_MESSAGES,
       sql="SELECT user_id, product_id, notification_type, title, body, channels, priority, data FROM messages")
def _(spark, d):
    return flat(_daily(spark, d)[2]).drop("notification_id")


@query("daily_batch_report", *EVERYONE, ACTIVE, DAILY, gate_sql(), DAILY_MESSAGES, sql="""
SELECT (SELECT count(*) FROM attempts) AS total_users, (SELECT count(*) FROM messages) AS sent,
  (SELECT count(*) FROM attempts) - (SELECT count(*) FROM admitted) AS rate_limited,
  (SELECT count(*) FROM admitted) - (SELECT count(*) FROM messages) AS no_result,
  ((SELECT count(*) FROM attempts) + 99) // 100 AS batches""")
def _(spark, d):
    return notify.daily_batch_report(*_daily(spark, d))
