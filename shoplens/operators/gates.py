"""Who may be notified: daily cap per user, then one message per (user, product, type) and hour.

An attempt frame has (attempt_id, user_id, product_id, notification_type, ts, seq); (ts, seq) is the arrival order.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.actions import notification_day
from shoplens.operators.ordered_fold import HOT_ROWS, Fold, ordered_fold

# Messages per user and day, hours before the same message may be sent again.
DAILY_LIMIT = 10
DUPLICATE_HOURS = 1
GATE_KEYS = ["user_id", "product_id", "notification_type"]


def within_daily_cap(attempts: DataFrame, limit: int = DAILY_LIMIT) -> DataFrame:
    """The first `limit` attempts of each user and day; every attempt counts, whatever becomes of it later.

    The rank limit is applied by each task before the shuffle, so a hot user costs at most `limit` rows per task.
    """
    dated = attempts.withColumn("day", notification_day(F.col("ts")))
    order = Window.partitionBy("user_id", "day").orderBy("ts", "seq")
    return dated.withColumn("attempt_no", F.row_number().over(order)).filter(F.col("attempt_no") <= limit)


def daily_cap(attempts: DataFrame, limit: int = DAILY_LIMIT) -> DataFrame:
    """Every attempt with `allowed` and, where allowed, its number on that day."""
    allowed = within_daily_cap(attempts, limit).select("attempt_id", "attempt_no")
    return (attempts.withColumn("day", notification_day(F.col("ts"))).join(allowed, "attempt_id", "left")
            .withColumn("allowed", F.col("attempt_no").isNotNull()))


class TtlFold(Fold):
    """Admit a row iff `ttl` has passed since the last admitted row of its key."""

    state_schema = "last_us bigint"

    def __init__(self, ttl_us: int, output_schema: str):
        self.ttl_us, self.output_schema = ttl_us, output_schema

    def load(self, batch):
        return batch.column("_us").to_numpy()

    def step(self, state, data, lo, hi):
        last = None if state is None else state["last_us"]
        admitted = []
        at = lo if last is None else lo + int(np.searchsorted(data[lo:hi], last + self.ttl_us))
        while at < hi:
            admitted.append(at)
            last = int(data[at])
            at += int(np.searchsorted(data[at:hi], last + self.ttl_us))
        return {"last_us": last}, admitted

    def settled(self, old, new):
        return F.col("o.last_us") == F.col("n.last_us")


def duplicate_gate(attempts: DataFrame, hours: int = DUPLICATE_HOURS, *, hot_rows: int = HOT_ROWS,
                   segments: int | None = None) -> DataFrame:
    """Admitted attempts of a log of any size; a hot key is split over tasks (see `ordered_fold`)."""
    rows = attempts.select("attempt_id", *GATE_KEYS, "ts", "seq", F.unix_micros("ts").alias("_us"))
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ["attempt_id", *GATE_KEYS, "ts", "seq"])
    fold = TtlFold(hours * 3_600_000_000, schema)
    return ordered_fold(rows, GATE_KEYS, ["_us", "seq"], fold, hot_rows=hot_rows, segments=segments)


def duplicate_gate_capped(capped: DataFrame, hours: int = DUPLICATE_HOURS) -> DataFrame:
    """The same gate without Python, for attempts that passed the daily cap.

    The first attempt after a pause of `hours` is admitted whatever went before, so a key falls into islands between pauses
    that don't know of each other. With `limit` attempts a day and `limit * hours` below a day, no island can bridge a whole
    day: it holds at most twice the limit, however many attempts the key has. Only islands are gathered.
    """
    rest = [c for c in capped.columns if c not in (*GATE_KEYS, "ts", "seq")]
    ttl = hours * 3_600_000_000
    by_time = Window.partitionBy(*GATE_KEYS).orderBy("ts", "seq")
    pause = F.coalesce(F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(by_time) >= ttl, F.lit(True))
    parted = capped.withColumn("_pause", pause.cast("int")) \
        .withColumn("_island", F.sum("_pause").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    per_island = parted.groupBy(*GATE_KEYS, "_island").agg(F.sort_array(F.collect_list(F.struct("ts", "seq", *rest))).alias("attempts"))
    start = F.struct(F.lit(None).cast("bigint").alias("last"), F.filter("attempts", lambda a: F.lit(False)).alias("sent"))

    def visit(state, attempt):
        us = F.unix_micros(attempt["ts"])
        free = state["last"].isNull() | (us >= state["last"] + ttl)
        return F.struct(F.when(free, us).otherwise(state["last"]).alias("last"),
                        F.when(free, F.array_append(state["sent"], attempt)).otherwise(state["sent"]).alias("sent"))

    admitted = per_island.select(*GATE_KEYS, F.explode(F.aggregate("attempts", start, visit)["sent"]).alias("a"))
    return admitted.select(*GATE_KEYS, "a.*").select(*capped.columns)


def can_send(attempts: DataFrame, limit: int = DAILY_LIMIT, hours: int = DUPLICATE_HOURS) -> DataFrame:
    """Attempts that pass the daily cap and then the duplicate gate."""
    capped = within_daily_cap(attempts, limit)
    if limit * hours < 24:
        return duplicate_gate_capped(capped, hours)
    # Islands may be long: rows are folded in order instead of gathered.
    return capped.join(duplicate_gate(capped, hours).select("attempt_id"), "attempt_id", "left_semi")
