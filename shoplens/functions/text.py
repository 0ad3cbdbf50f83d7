"""Texts: notification titles, bodies and payloads, product texts and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Notification texts (shown to users in Korean) and the name used for an unknown product.
TITLES = {
    "PRICE_DROP": "가격이 떨어졌어요!",
    "BACK_IN_STOCK": "재입고 알림",
    "RECOMMENDATION": "오늘의 추천 상품",
}
PRICE_DROP_BODY = "%s이(가) %d%% 할인 중입니다!"
BACK_IN_STOCK_BODY = "%s이(가) 다시 입고되었습니다!"
RECOMMENDATION_BODY = "%s을(를) 추천드려요!"
UNKNOWN_PRODUCT = "상품"

# Prefixes the text encoder expects.
PASSAGE_PREFIX = "passage: "
QUERY_PREFIX = "query: "


def title(notification_type: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in TITLES.items() for x in pair])
    return F.try_element_at(names, notification_type)


def price_drop_body(product_name: Column, drop: Column) -> Column:
    return F.format_string(PRICE_DROP_BODY, F.coalesce(product_name, F.lit(UNKNOWN_PRODUCT)), drop)


def back_in_stock_body(product_name: Column) -> Column:
    return F.format_string(BACK_IN_STOCK_BODY, F.coalesce(product_name, F.lit(UNKNOWN_PRODUCT)))


def recommendation_body(product_names: Column) -> Column:
    """`product_names` in rank order."""
    return F.format_string(RECOMMENDATION_BODY, F.array_join(product_names, ", "))


def price_drop_data(previous: Column, current: Column, drop: Column) -> Column:
    return F.create_map(
        F.lit("previousPrice"), previous.cast("float").cast("string"),
        F.lit("currentPrice"), current.cast("float").cast("string"),
        F.lit("dropPercentage"), drop.cast("string"))


def back_in_stock_data(current_stock: Column) -> Column:
    return F.create_map(F.lit("currentStock"), current_stock.cast("string"))


def recommendation_data(strategy: Column, product_ids: Column) -> Column:
    return F.create_map(
        F.lit("strategy"), strategy,
        F.lit("productCount"), F.size(product_ids).cast("string"),
        F.lit("productIds"), F.array_join(product_ids, ","))


def product_text(name: Column, category: Column, description: Column) -> Column:
    """Text that is encoded for a product."""
    body = F.concat_ws(" ", name, category, description)
    return F.concat(F.lit(PASSAGE_PREFIX), body)


def product_text_with_brand(name: Column, category: Column, brand: Column, description: Column) -> Column:
    """Documented variant: brand included, description limited to its first 200 characters."""
    return F.concat(F.lit(PASSAGE_PREFIX), F.concat_ws(" ", name, category, brand, F.substring(description, 1, 200)))


def query_text(text: Column) -> Column:
    return F.concat(F.lit(QUERY_PREFIX), text)


def product_key(category: Column, seq: Column) -> Column:
    # format_string, as lpad would cut sequence numbers beyond five digits
    return F.concat(F.lit("PROD-"), F.substring(category, 1, 3), F.format_string("-%05d", seq))


def user_key(seq: Column) -> Column:
    return F.format_string("USER-%06d", seq)
