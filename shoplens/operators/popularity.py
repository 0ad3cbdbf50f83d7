"""Popular products, overall and per category, with the tiered fall-back for thin data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators.filters import recent_window
from shoplens.operators.topk import top_overall, top_per_group

WINDOW_DAYS = 7
POPULAR_LIMIT = 100
CATEGORY_LIMIT = 50


def product_counts(actions: DataFrame, as_of: Column, keys: list[str], days: int = WINDOW_DAYS) -> DataFrame:
    """Purchases and views+clicks per product, in one pass with map-side combine."""
    recent = recent_window(actions, as_of, days).filter(F.col("action_type").isin("PURCHASE", "VIEW", "CLICK"))
    return recent.groupBy(*keys).agg(
        F.count_if(F.col("action_type") == "PURCHASE").alias("purchases"),
        F.count_if(F.col("action_type") != "PURCHASE").alias("visits"))


def _by_tier(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Purchases as tier 1, visits as tier 2, each with its count `n`."""
    tiers = F.array(F.struct(F.lit(1).alias("tier"), F.col("purchases").alias("n")),
                    F.struct(F.lit(2).alias("tier"), F.col("visits").alias("n")))
    return counts.select(*keys, F.inline(tiers)).filter("n > 0")


def _details(ranked: DataFrame, goods: DataFrame, keys: list[str]) -> DataFrame:
    """Attach catalogue columns after the limit: unknown products shorten the list, the ranks stay."""
    return (F.broadcast(ranked).join(goods.select("product_id", "product_name", "category", "price"), keys)
            .withColumn("score", F.lit(0.0)))


def popular_products(actions: DataFrame, goods: DataFrame, as_of: Column, limit: int = POPULAR_LIMIT,
                     pool: int = POPULAR_LIMIT) -> DataFrame:
    """Most bought of the week; without any purchase the most visited; without any visit the newest products."""
    # Both tiers come from one pass over the actions; their rank limit applies before the shuffle.
    visited = top_per_group(_by_tier(product_counts(actions, as_of, ["product_id"]), ["product_id"]),
                            ["tier"], [F.desc("n"), F.asc("product_id")], pool)
    newest = top_overall(goods.select("product_id", F.col("created_at_ms").alias("n")),
                         [F.desc("n"), F.asc("product_id")], pool).withColumn("tier", F.lit(3))
    # At most 3 * pool rows from here on.
    ranked = (visited.unionByName(newest)
              .withColumn("first_tier", F.min("tier").over(Window.partitionBy(F.lit(1))))
              .filter((F.col("tier") == F.col("first_tier")) & (F.col("rank") <= limit))
              .select("product_id", "rank", "tier"))
    return _details(ranked, goods, ["product_id"])


def popular_details(ranked: DataFrame, goods: DataFrame) -> DataFrame:
    """Catalogue columns of a ranked id list (bounded by its limit); order kept, unknown ids dropped."""
    return _details(ranked, goods, ["product_id"])


def category_best(actions: DataFrame, goods: DataFrame, as_of: Column, limit: int = CATEGORY_LIMIT) -> DataFrame:
    """As `popular_products` within each category; the fall-back is decided category by category."""
    counts = product_counts(actions, as_of, ["category", "product_id"])
    measured = _by_tier(counts, ["category", "product_id"])
    newest = goods.select("category", "product_id", F.lit(3).alias("tier"), F.col("created_at_ms").alias("n"))
    ranked = top_per_group(measured.unionByName(newest).filter(F.col("category").isNotNull()),
                           ["category", "tier"], [F.desc("n"), F.asc("product_id")], limit)
    kept = (ranked.withColumn("first_tier", F.min("tier").over(Window.partitionBy("category")))
            .filter(F.col("tier") == F.col("first_tier")))
    details = goods.select("category", "product_id", "product_name", "price")
    return (kept.join(details, ["category", "product_id"])
            .select("category", "product_id", "product_name", "price", "rank", "tier")
            .withColumn("score", F.lit(0.0)))
