"""Daily cap and duplicate gate as keyed streaming state."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shoplens.functions.actions import notification_day
from shoplens.operators.gates import DAILY_LIMIT, DUPLICATE_HOURS

KEPT_DAYS = 2  # counters of older days are forgotten


class GateProcessor(StatefulProcessor):
    """Per user: a counter per day and the last sending time per product and type, read and written once per batch.

    Of a micro-batch only the earliest `limit` attempts of each day can pass, so no more than those are held in
    memory, however many a user has. With `hours=None` only the daily cap applies.
    """

    def __init__(self, limit: int = DAILY_LIMIT, hours: int | None = DUPLICATE_HOURS):
        self.limit, self.hours = limit, hours

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.memory = handle.getValueState(
            "memory", "days array<int>, counts array<bigint>, sent array<string>, times array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest, totals = None, Counter()
        for part in rows:
            totals.update(part["day"].tolist())
            earliest = self._earliest(part if earliest is None else pd.concat([earliest, part]))
        days, used, what_sent, times = self.memory.get() if self.memory.exists() else ([], [], [], [])
        counts, sent = dict(zip(days, used)), dict(zip(what_sent, times))
        passed = []
        for at, (day, kind, product, us) in enumerate(zip(*[
                earliest[c].tolist() for c in ("day", "notification_type", "product_id", "us")])):
            counts[day] = counts.get(day, 0) + 1
            totals[day] -= 1
            if counts[day] <= self.limit and (self.hours is None or self._is_first(sent, kind, product, us)):
                passed.append(at)
        for day, n in totals.items():  # attempts beyond the earliest ones count as well
            counts[day] += n
        newest_day, newest_us = max(counts), int(earliest["us"].max())
        counts = {d: n for d, n in counts.items() if d >= newest_day - KEPT_DAYS}
        sent = {w: us for w, us in sent.items() if us >= newest_us - KEPT_DAYS * 86_400_000_000}
        self.memory.update((list(counts), list(counts.values()), list(sent), list(sent.values())))
        yield earliest.iloc[passed][["attempt_id", "user_id", "product_id", "notification_type", "us", "seq"]]

    def _earliest(self, attempts: pd.DataFrame) -> pd.DataFrame:
        """The first `limit` attempts of each day, ordered by day and arrival."""
        day = attempts["day"].to_numpy()
        order = np.lexsort((attempts["seq"].to_numpy(), attempts["us"].to_numpy(), day))
        day = day[order]
        first = np.searchsorted(day, day)
        return attempts.iloc[order[np.arange(len(day)) - first < self.limit]]

    def _is_first(self, sent: dict, kind: str, product: str, us: int) -> bool:
        """Is the message free to be sent? If so, note its time."""
        what = f"{kind}|{product}"
        if what in sent and us < sent[what] + self.hours * 3_600_000_000:
            return False
        sent[what] = int(us)
        return True

    def close(self) -> None:
        pass


OUTPUT = "attempt_id string, user_id bigint, product_id string, notification_type string, us bigint, seq bigint"


def gate_stream(attempts: DataFrame, limit: int = DAILY_LIMIT, hours: int | None = DUPLICATE_HOURS) -> DataFrame:
    """Admitted attempts of a stream, in arrival order per user (product ids as text)."""
    rows = attempts.select(
        "attempt_id", "user_id", F.col("product_id").cast("string").alias("product_id"), "notification_type", "seq",
        F.unix_micros("ts").alias("us"), F.unix_date(notification_day(F.col("ts"))).alias("day"))
    admitted = rows.groupBy("user_id").transformWithStateInPandas(GateProcessor(limit, hours), OUTPUT, "Append", "None")
    return admitted.withColumn("ts", F.timestamp_micros("us")).drop("us")
