"""Ranking, top-k per group and paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.session import durable

_POSITION_BITS = 33  # monotonically_increasing_id = partition id << 33 | position
# Up to this rank Spark itself cuts each task's part of a group before the shuffle (window group limit).
PUSHED_RANK_LIMIT = 1000


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int | None, rank: str = "rank",
                  spread_by: str | None = None, salts: int = 64) -> DataFrame:
    """First `n` rows of each group (None: all) with their rank.

    Small `n`: one window, whose limit Spark pushes below the shuffle. Large `n`: the group is first ranked in
    `salts` parts by the hash of `spread_by`, so a hot group is sorted by many tasks and only `salts * n` rows meet.
    """
    whole = Window.partitionBy(*keys).orderBy(*order)
    if n is None:
        return df.withColumn(rank, F.row_number().over(whole))
    if n > PUSHED_RANK_LIMIT and spread_by is not None:
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
              .withColumn("_part_rank", F.row_number().over(part))
              .filter(F.col("_part_rank") <= n).drop("_salt", "_part_rank"))
    return df.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n)


def top_overall(df: DataFrame, order: list[Column], n: int | None, rank: str = "rank") -> DataFrame:
    """First `n` rows of the whole frame (None: all) with their rank: a distributed top-n, then a window over `n` rows.

    All rows are ranked where a range partitioning puts them, after the number of rows in the partitions before.
    """
    if n is not None:
        return df.orderBy(*order).limit(n).withColumn(rank, F.row_number().over(Window.orderBy(*order)))
    laid = durable(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, within = F.shiftright("_at", _POSITION_BITS), F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # One row per partition.
    sizes = laid.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return laid.withColumn("_part", part).join(F.broadcast(before), "_part") \
        .withColumn(rank, (F.col("_before") + within + 1).cast("int")).drop("_at", "_part", "_before")


def page(df: DataFrame, order: list[Column], page_no: int, size: int) -> DataFrame:
    """Page `page_no` (from 0) of `size` rows."""
    return df.orderBy(*order).offset(page_no * size).limit(size)


def latest_products(goods: DataFrame, limit: int, category: str | None = None) -> DataFrame:
    """Newest products with score 0."""
    if category is not None:
        goods = goods.filter(F.col("category") == category)
    return top_overall(
        goods.select("product_id", "product_name", "category", "price", "created_at_ms"),
        [F.desc("created_at_ms"), F.asc("product_id")], limit).withColumn("score", F.lit(0.0))
