"""Idempotent writes, change sets, rejects and retention.

A table is kept as a log of change batches, one directory per batch id. Writing a batch costs only the batch, and
writing it again after a failure replaces it. Readers resolve the newest row per key with a map-side combined
aggregation; `compact` folds the log into one batch when it grows long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Newest row of each key, last write wins; rows without a key are all kept."""
    rest = [c for c in rows.columns if c != key]
    keyed = (rows.filter(F.col(key).isNotNull()).groupBy(key)
             .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(key, "_row.*"))
    return keyed.select(*rows.columns).unionByName(rows.filter(F.col(key).isNull()))


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Append a batch; a repeated batch id, an empty one too, replaces the batch's own directory."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_current(spark: SparkSession, path: str, key: str, order: list[str], schema: T.StructType) -> DataFrame:
    """Newest row per key over all batches; later batches win over earlier ones."""
    log = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(path)
    return latest_per_key(log, key, ["batch_id", *order]).drop("batch_id")


def compact(spark: SparkSession, path: str, target: str, key: str, order: list[str], schema: T.StructType) -> None:
    """Write the resolved rows of the log at `path` as the first batch of a new log at `target`."""
    write_batch(read_current(spark, path, key, order, schema), target, 0)


def split_rejects(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy every rule, and the others with the names of the broken rules."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]),
                      lambda r: r.isNotNull())
    judged = rows.withColumn("reject_reasons", broken)
    return (judged.filter(F.size("reject_reasons") == 0).drop("reject_reasons"),
            judged.filter(F.size("reject_reasons") > 0))


def action_rules(known_types: list[str]) -> dict[str, Column]:
    """What an action must fulfil to be stored."""
    return {
        "no user": F.col("user_id").isNotNull(),
        "no product": F.col("product_id").isNotNull(),
        "unknown action": F.col("action_type").isin(known_types),
        "no time": F.col("ts").isNotNull(),
    }


def retention(rows: DataFrame, ts: str, as_of: Column, days: int) -> DataFrame:
    """Rows that are still inside their retention period."""
    return rows.filter(F.col(ts) >= as_of - F.expr(f"INTERVAL {days} DAYS"))


# Retention in days.
RETENTION_DAYS = {"user_actions": 7, "inventory_events": 7, "notifications": 1, "dead_letters": 30, "logs": 7,
                  "metrics": 15}


def apply_changes(stored: DataFrame, changes: DataFrame, key: str, note: str = "note") -> DataFrame:
    """Stored rows after a batch of changes: `changes(key, seq, op, *columns)`, op in insert, note, delete.

    The last insert or delete of a key decides whether it exists; a note set after that replaces its note. A note
    on a row that does not exist is ignored. One aggregation per key, whatever the number of changes.
    """
    columns = [c for c in stored.columns if c != key]
    log = (stored.select(key, F.lit(-1).cast("bigint").alias("seq"), F.lit("insert").alias("op"), *columns)
           .unionByName(changes.select(key, F.col("seq").cast("bigint"), "op", *columns)))
    sets, notes = F.col("op").isin("insert", "delete"), F.col("op") == "note"
    state = log.groupBy(key).agg(
        F.max_by(F.struct("op", "seq", *columns), F.when(sets, F.col("seq"))).alias("s"),
        F.max_by(F.struct("seq", note), F.when(notes, F.col("seq"))).alias("n"))
    kept = state.filter(F.col("s.op") == "insert")
    newer = F.coalesce(F.col("n.seq") > F.col("s.seq"), F.lit(False))
    return kept.select(key, *[
        (F.when(newer, F.col(f"n.{note}")).otherwise(F.col(f"s.{c}")) if c == note else F.col(f"s.{c}")).alias(c)
        for c in columns])
