"""Recommendations: recently seen products, vector search per user and the choice of strategy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.operators.filters import recent_window
from shoplens.operators.knn import knn_candidates, knn_join
from shoplens.operators.popularity import category_best, popular_products
from shoplens.operators.topk import top_per_group

# How far back and how many events "recently viewed" and "recently purchased" look.
VIEWED_ACTIONS, VIEWED_DAYS, VIEWED_EVENTS = ["VIEW", "CLICK"], 7, 100
PURCHASED_ACTIONS, PURCHASED_DAYS, PURCHASED_EVENTS = ["PURCHASE"], 30, 50
MAX_RECOMMENDATIONS = 50


def clamp_limit(limit: int) -> int:
    return max(1, min(limit, MAX_RECOMMENDATIONS))


def _recent_products(actions: DataFrame, as_of: Column, types: list[str], days: int, events: int) -> DataFrame:
    """The newest `events` events of each user, then distinct products with the rank of their newest event."""
    newest = top_per_group(recent_window(actions, as_of, days).filter(F.col("action_type").isin(types)),
                           ["user_id"], [F.desc("ts"), F.desc("event_id")], events)
    return newest.groupBy("user_id", "product_id").agg(F.min("rank").alias("rank"))


def recent_viewed(actions: DataFrame, as_of: Column, events: int = VIEWED_EVENTS) -> DataFrame:
    return _recent_products(actions, as_of, VIEWED_ACTIONS, VIEWED_DAYS, events)


def recent_purchased(actions: DataFrame, as_of: Column, events: int = PURCHASED_EVENTS) -> DataFrame:
    return _recent_products(actions, as_of, PURCHASED_ACTIONS, PURCHASED_DAYS, events)


def knn_recommend(preferences: DataFrame, goods: DataFrame, k: int, dims: int, *, category: str | None = None,
                  viewed: DataFrame | None = None, **blocks) -> DataFrame:
    """Ranked products per user with a vector; filters apply before the search, `viewed` pairs are left out."""
    users = preferences.select("user_id", "preference_vector")
    if viewed is None:
        users = users.withColumn("exclude", F.lit(None).cast(f"array<{dict(goods.dtypes)['product_id']}>"))
    else:
        # At most VIEWED_EVENTS ids per user, by construction of `recent_viewed`.
        seen = viewed.groupBy("user_id").agg(F.collect_set("product_id").alias("exclude"))
        users = users.join(seen, "user_id", "left")
    ranked = knn_join(users, knn_candidates(goods, dims, category), clamp_limit(k), dims, **blocks)
    return ranked.join(goods.select("product_id", "product_name", "category", "price"), "product_id").select(
        "user_id", "product_id", "product_name", "category", "price", "score", "rank")


def recommend_all(users: DataFrame, preferences: DataFrame, goods: DataFrame, actions: DataFrame, as_of: Column,
                  limit: int, dims: int, *, category: str | None = None, skip_viewed: bool = True) -> DataFrame:
    """Recommendations of every user: by vector where there is one, else the popular or category list.

    `actions` needs `category` if one is asked for. A user whose stored vector has the wrong length gets the popular
    list under the label `fallback`.
    """
    limit = clamp_limit(limit)
    known = users.select("user_id").distinct().join(
        preferences.select("user_id", "preference_vector"), "user_id", "left")
    by_vector = known.filter(F.size("preference_vector") == dims)
    viewed = recent_viewed(actions, as_of) if skip_viewed else None
    near = knn_recommend(by_vector, goods, limit, dims, category=category, viewed=viewed).withColumn(
        "strategy", F.lit("knn"))

    cold = known.filter(F.col("preference_vector").isNull() | (F.size("preference_vector") != dims)).select(
        "user_id", F.col("preference_vector").isNotNull().alias("broken"))
    item = F.struct("rank", "product_id", "product_name", "category", "price", "score")

    def as_list(ranked: DataFrame) -> Column:
        # One value: at most `limit` products, so it travels inside the plan and no join is needed.
        return ranked.agg(F.sort_array(F.collect_list(item)).alias("items")).scalar()

    popular = as_list(popular_products(actions, goods, as_of, limit))
    if category is None:
        lists = popular
        label = F.when(F.col("broken"), "fallback").otherwise("popularity")
    else:
        best = as_list(category_best(actions, goods, as_of, limit).filter(F.col("category") == category))
        lists = F.when(F.col("broken"), popular).otherwise(best)
        label = F.when(F.col("broken"), "fallback").otherwise("category_best")
    filled = (cold.select("user_id", label.alias("strategy"), F.explode(lists).alias("i"))
              .select("user_id", "strategy", "i.*"))
    return near.unionByName(filled.select(*near.columns))


def as_responses(recommendations: DataFrame) -> DataFrame:
    """One row per user with the ranked list, as a response carries it."""
    item = F.struct("rank", "product_id", "product_name", "category", "price", "score")
    return recommendations.groupBy("user_id", "strategy").agg(
        F.sort_array(F.collect_list(item)).alias("recommendations"))
