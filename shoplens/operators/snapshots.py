"""Published lists with a time to live."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators.dated import exists, take_lease

TTL_MINUTES = 10


def write_snapshot(ranked: DataFrame, path: str, computed_at: Column) -> None:
    """Store a ranked list under the time it was computed; an empty list writes no rows, and so counts as none."""
    (ranked.withColumn("computed_at", computed_at).write.mode("append").parquet(path))


def read_snapshot(spark: SparkSession, path: str, as_of: Column, ttl_minutes: int = TTL_MINUTES) -> DataFrame:
    """The newest list that is still alive at `as_of`; no rows tell the caller to compute a new one."""
    kept = spark.read.parquet(path).filter(
        (F.col("computed_at") <= as_of) & (F.col("computed_at") > as_of - F.expr(f"INTERVAL {ttl_minutes} MINUTES")))
    return kept.filter(F.col("computed_at") == kept.agg(F.max("computed_at")).scalar())


def refresh_snapshot(spark: SparkSession, path: str, schema: T.StructType, compute: Callable[[], DataFrame], as_of: dt.datetime,
                     ttl_minutes: int = TTL_MINUTES) -> DataFrame:
    """The list at `as_of`: the stored one while it lives, else computed, stored and returned.

    While one caller computes, others get the newest list there is, alive or not; so a list is computed at most once in
    `ttl_minutes`. An empty list is not stored, and the next caller computes again. A caller that died leaves its lease for
    `ttl_minutes` of the file system's time.
    """
    stored = T.StructType([*schema.fields, T.StructField("computed_at", T.TimestampType())])
    now = F.to_timestamp(F.lit(as_of.isoformat(sep=" ")))

    def newest(ttl: int | None) -> DataFrame:
        if not exists(spark, path):
            return spark.createDataFrame([], schema)
        kept = spark.read.schema(stored).parquet(path).filter(F.col("computed_at") <= now)
        if ttl is not None:
            kept = kept.filter(F.col("computed_at") > now - F.expr(f"INTERVAL {ttl} MINUTES"))
        return kept.filter(F.col("computed_at") == kept.agg(F.max("computed_at")).scalar()).select(*schema.fieldNames())

    alive = newest(ttl_minutes)
    if not alive.isEmpty():
        return alive
    with take_lease(spark, f"{path}-lease", time.time() - 60 * ttl_minutes) as mine:
        if not mine:
            return newest(None)
        write_snapshot(compute().select(*schema.fieldNames()), path, now)
    return newest(ttl_minutes)
