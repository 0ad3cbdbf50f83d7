"""From inventory events and daily batches to notifications, deliveries and their history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import text
from shoplens.functions.actions import drop_percentage, is_price_drop, is_restock
from shoplens.operators.gates import DAILY_LIMIT, can_send
from shoplens.operators.interest import (
    PRICE_DROP_ACTIONS, PRICE_DROP_DAYS, RESTOCK_ACTIONS, RESTOCK_DAYS, active_users, first_drop_and_restock_targets, first_targets,
    target_totals)
from shoplens.session import durable, stored

# Send in chunks of 100 with a 50 ms pause; products per daily message; gate key of the daily message.
CHUNK_SIZE, CHUNK_PAUSE_MS = 100, 50
DAILY_PRODUCTS = 3
DAILY_GATE_KEY = "DAILY_RECOMMENDATION"
PRICE_DROP_PERCENT = 10


def price_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "PRICE_CHANGE")


def stock_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "STOCK_CHANGE")


def price_drops(events: DataFrame, threshold: int = PRICE_DROP_PERCENT) -> DataFrame:
    p, c = F.col("previous_price"), F.col("current_price")
    return price_events(events).filter(is_price_drop(p, c, threshold)).withColumn("drop_percentage", drop_percentage(p, c))


def restocks(events: DataFrame) -> DataFrame:
    return stock_events(events).filter(is_restock(F.col("previous_stock"), F.col("current_stock")))


def attach_product_name(rows: DataFrame, goods: DataFrame) -> DataFrame:
    """Product name, or the default for a product that is not in the catalogue."""
    names = goods.select("product_id", F.col("product_name").alias("_name"))
    return (rows.join(names, "product_id", "left")
            .withColumn("product_name", F.coalesce("_name", F.lit(text.UNKNOWN_PRODUCT))).drop("_name"))


def notification_id(*parts) -> Column:
    """Reproducible id, so that a replay writes the same row again."""
    return F.sha2(F.concat_ws("|", *[p if isinstance(p, Column) else F.col(p) for p in parts]), 256)


def attempts_of(targets: DataFrame, events: DataFrame, notification_type: str) -> DataFrame:
    """One send attempt per (event, user), in the order of the events and, of one event, of the ranks.

    `seq` holds the event's number above the rank (below 2^31), so no limit on ranks is needed; a number of 2^32 or more
    is an error.
    """
    number = F.col("event_seq").cast("bigint")
    number = F.when(number < 1 << 32, number).when(number.isNotNull(), F.raise_error(F.lit("event numbers must be below 2^32")).cast("bigint"))
    return targets.join(events.select("inventory_event_id", "product_id", "ts", F.col("seq").alias("event_seq")),
                        "inventory_event_id").select(
        F.concat_ws("|", "inventory_event_id", "user_id").alias("attempt_id"), "inventory_event_id", "user_id",
        "product_id", F.lit(notification_type).alias("notification_type"), "ts",
        (F.shiftleft(number, 31) + F.col("rank")).alias("seq"), "rank")


def _message(sent: DataFrame, goods: DataFrame, body, data, channels: list[str]) -> DataFrame:
    named = attach_product_name(sent, goods)
    return named.select(
        notification_id("inventory_event_id", "user_id", "notification_type").alias("notification_id"),
        "user_id", "product_id", "notification_type",
        text.title(F.col("notification_type")).alias("title"), body.alias("body"), data.alias("data"),
        F.array(*[F.lit(c) for c in channels]).alias("channels"), F.lit("HIGH").alias("priority"), "ts",
        F.col("inventory_event_id").alias("trace_id"))


def price_drop_notifications(admitted: DataFrame, drops: DataFrame, goods: DataFrame) -> DataFrame:
    facts = drops.select("inventory_event_id", "previous_price", "current_price", "drop_percentage")
    rows = admitted.join(facts, "inventory_event_id")
    drop = F.col("drop_percentage")
    return _message(rows, goods, text.price_drop_body(F.col("product_name"), drop),
                    text.price_drop_data(F.col("previous_price"), F.col("current_price"), drop), ["PUSH", "IN_APP"])


def restock_notifications(admitted: DataFrame, found: DataFrame, goods: DataFrame) -> DataFrame:
    rows = admitted.join(found.select("inventory_event_id", "current_stock"), "inventory_event_id")
    return _message(rows, goods, text.back_in_stock_body(F.col("product_name")),
                    text.back_in_stock_data(F.col("current_stock")), ["PUSH", "SMS"])


def detect_price_drop(events: DataFrame, actions: DataFrame, goods: DataFrame, limit: int | None = None) -> DataFrame:
    """Messages of the price drops alone; together with other kinds, `send_all` applies the one daily cap."""
    drops = price_drops(events)
    targets, = first_targets([(drops, PRICE_DROP_ACTIONS, PRICE_DROP_DAYS)], actions, DAILY_LIMIT, limit)
    attempts = attempts_of(targets, drops, "PRICE_DROP")
    return price_drop_notifications(can_send(attempts), drops, goods)


def detect_restock(events: DataFrame, actions: DataFrame, goods: DataFrame,
                   action_types: list[str] = RESTOCK_ACTIONS, limit: int | None = None) -> DataFrame:
    """Messages of the restocks alone; together with other kinds, `send_all` applies the one daily cap."""
    found = restocks(events)
    targets, = first_targets([(found, action_types, RESTOCK_DAYS)], actions, DAILY_LIMIT, limit)
    attempts = attempts_of(targets, found, "BACK_IN_STOCK")
    return restock_notifications(can_send(attempts), found, goods)


def first_attempts(drops: DataFrame, back: DataFrame, actions: DataFrame, action_types: list[str] = RESTOCK_ACTIONS,
                   limit: int | None = None) -> list[DataFrame]:
    """The attempts of price drops and of restocks, at least the first of each user and day, as many as the daily cap admits.

    The daily cap counts attempts in their order, so no later one can be admitted."""
    targets = first_drop_and_restock_targets(drops, back, actions, DAILY_LIMIT, action_types, limit)
    return [attempts_of(targets[0], drops, "PRICE_DROP"), attempts_of(targets[1], back, "BACK_IN_STOCK")]


def send_all(events: DataFrame, actions: DataFrame, as_of: Column, action_types: list[str] = RESTOCK_ACTIONS,
             limit: int | None = None) -> DataFrame:
    """What may be sent of price drops, restocks and the daily batch together: all kinds count to one daily cap per user."""
    drops, back = price_drops(events), restocks(events)
    columns = ["attempt_id", "user_id", "product_id", "notification_type", "ts", "seq"]
    kinds = [*first_attempts(drops, back, actions, action_types, limit),
             daily_attempts(actions, as_of, limit)]
    kinds = [k.select(*columns).withColumn("product_id", F.col("product_id").cast("string")) for k in kinds]
    return can_send(kinds[0].unionByName(kinds[1]).unionByName(kinds[2])).select(*columns)


def notification_funnel(events: DataFrame, actions: DataFrame, goods: DataFrame, action_types: list[str] = RESTOCK_ACTIONS,
                        limit: int | None = None) -> DataFrame:
    """One row: drops and restocks detected, messages triggered, attempts limited, messages sent and failed, history rows saved.

    Each stage is computed once and counted where it lies; all attempts are counted, those that the daily cap holds back without
    being written out.
    """
    drops, back = durable(price_drops(events)), durable(restocks(events))
    drop_attempts, back_attempts = first_attempts(drops, back, actions, action_types, limit)
    admitted = stored(can_send(drop_attempts.unionByName(back_attempts)), "admitted")
    totals = [(drops, PRICE_DROP_ACTIONS, PRICE_DROP_DAYS), (back, action_types, RESTOCK_DAYS)]
    attempts = [target_totals(found, actions, types, days, limit).join(found.select("inventory_event_id"), "inventory_event_id").select("n")
                for found, types, days in totals]
    n_attempts = attempts[0].unionByName(attempts[1]).agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint"))).scalar()
    kind = F.col("notification_type")
    history = delivery_history(price_drop_notifications(admitted.filter(kind == "PRICE_DROP"), drops, goods).unionByName(
        restock_notifications(admitted.filter(kind == "BACK_IN_STOCK"), back, goods)), F.col("ts"))
    count = lambda df: df.agg(F.count("*")).scalar()
    return history.agg(
        F.count_if(F.col("status") == "SENT").alias("sent"), F.count_if(F.col("status") == "FAILED").alias("send_failed"),
        F.count("*").alias("saved")).select(
        (count(drops) + count(back)).alias("detected"), count(admitted).alias("triggered"),
        (n_attempts - count(admitted)).alias("rate_limited"), "sent", "send_failed", "saved")


def send_schedule(ranked: DataFrame, size: int = CHUNK_SIZE, pause_ms: int = CHUNK_PAUSE_MS) -> DataFrame:
    """Chunk number and delay of each ranked receiver (`rank` from 1)."""
    chunk = F.call_function("div", F.col("rank") - 1, F.lit(size))
    return ranked.withColumn("chunk", chunk).withColumn("delay_ms", chunk * pause_ms)


def daily_attempts(actions: DataFrame, as_of: Column, limit: int | None = None) -> DataFrame:
    """An attempt for each active user, at most `limit` of them, the most active first."""
    users = active_users(actions, as_of, limit=limit)
    return users.select(
        F.concat_ws("|", F.lit("daily"), "user_id").alias("attempt_id"), "user_id",
        F.lit(DAILY_GATE_KEY).alias("product_id"), F.lit("RECOMMENDATION").alias("notification_type"),
        as_of.alias("ts"), F.col("rank").cast("bigint").alias("seq"), "rank")


def daily_recommendations(admitted: DataFrame, recommendations: DataFrame, limit: int = DAILY_PRODUCTS) -> DataFrame:
    """Messages of the daily batch. `admitted` already used up its quota, whether or not products are found."""
    item = F.struct("rank", "product_id", "product_name")
    lists = (recommendations.filter(F.col("rank") <= limit).groupBy("user_id", "strategy")
             .agg(F.sort_array(F.collect_list(item)).alias("items")))
    ids = F.transform("items", lambda i: i["product_id"].cast("string"))
    return admitted.select("user_id", "attempt_id", "ts").join(lists, "user_id").select(
        notification_id("attempt_id", "ts").alias("notification_id"), "user_id",
        F.col("items")[0]["product_id"].alias("product_id"), F.lit("RECOMMENDATION").alias("notification_type"),
        text.title(F.lit("RECOMMENDATION")).alias("title"),
        text.recommendation_body(F.transform("items", lambda i: i["product_name"])).alias("body"),
        text.recommendation_data(F.col("strategy"), ids).alias("data"),
        F.array(F.lit("PUSH"), F.lit("IN_APP")).alias("channels"), F.lit("NORMAL").alias("priority"), "ts",
        F.lit(None).cast("string").alias("trace_id"))


def daily_batch_report(attempts: DataFrame, admitted: DataFrame, messages: DataFrame) -> DataFrame:
    """One row: users looked at, sent, rate limited, without result, chunks."""
    flags = (attempts.select("user_id")
             .join(admitted.select("user_id", F.lit(1).alias("ok")), "user_id", "left")
             .join(messages.select("user_id", F.lit(1).alias("sent")), "user_id", "left"))
    return flags.agg(
        F.count("*").alias("total_users"), F.count("sent").alias("sent"),
        F.count_if(F.col("ok").isNull()).alias("rate_limited"),
        F.count_if(F.col("ok").isNotNull() & F.col("sent").isNull()).alias("no_result"),
        F.call_function("div", F.count("*") + CHUNK_SIZE - 1, F.lit(CHUNK_SIZE)).alias("batches"))


def deliveries(notifications: DataFrame) -> DataFrame:
    """One row per notification and channel."""
    return notifications.withColumn("channel", F.explode("channels"))


def delivery_history(notifications: DataFrame, sent_at: Column) -> DataFrame:
    """History rows: a channel outside the known ones makes the delivery fail."""
    from shoplens.schemas import CHANNELS

    known = F.forall("channels", lambda c: c.isin(CHANNELS))
    return notifications.withColumn("status", F.when(known, "SENT").otherwise("FAILED")).withColumn("sent_at", sent_at)
