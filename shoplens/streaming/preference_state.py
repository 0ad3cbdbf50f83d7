"""Taste vectors as keyed streaming state: the stream form of the sequential fold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shoplens.functions.actions import action_alpha
from shoplens.operators.preferences import TasteFold, attach_vectors

STATE = "preference_vector array<double>, action_count bigint"
OUTPUT = "user_id bigint, preference_vector array<double>, action_count bigint, updated_us bigint"


class _Lookup:
    """Row number to product vector."""

    def __init__(self, vectors: dict, products: list):
        self.vectors, self.products = vectors, products

    def __getitem__(self, row: int) -> np.ndarray:
        return self.vectors[self.products[row]]


class TasteProcessor(StatefulProcessor):
    """Per user: restore from the backup, fold the rows of a micro-batch in arrival order, emit the new vector."""

    def __init__(self, ttl_hours: int | None = None):
        self.ttl_hours = ttl_hours

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = None if self.ttl_hours is None else self.ttl_hours * 3_600_000
        self.taste = handle.getValueState("taste", STATE, ttl)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        self.taste.update((row["preference_vector"].tolist(), int(row["action_count"])))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Only (product, rate, time) is kept per row, and one vector per distinct product.
        vectors, slim = {}, []
        for part in rows:
            for product, vector in zip(part["product_id"].tolist(), part["product_vector"].array):
                if product not in vectors:
                    vectors[product] = np.asarray(vector, dtype=np.float64)
            slim.append([part[c].to_numpy() for c in ("product_id", "alpha", "us", "event_id")])
        product, alpha, us, event = (np.concatenate(c) for c in zip(*slim))
        order = np.lexsort((event, us))
        n = len(order)
        known = self.taste.get() if self.taste.exists() else None
        state = None if known is None else {"preference_vector": np.asarray(known[0]), "action_count": known[1]}
        data = _Lookup(vectors, product[order].tolist()), alpha[order].tolist(), range(n + 1)
        state, _ = TasteFold().step(state, data, 0, n)
        vector = state["preference_vector"].tolist()
        self.taste.update((vector, state["action_count"]))
        yield pd.DataFrame({"user_id": [key[0]], "preference_vector": [vector], "action_count": [state["action_count"]],
                            "updated_us": [us[order[-1]]]})

    def close(self) -> None:
        pass


def preference_stream(actions: DataFrame, vectors: DataFrame, dims: int, backup: DataFrame | None = None,
                      ttl_hours: int | None = None) -> DataFrame:
    """Stream of updated vectors; `backup(user_id, preference_vector, action_count)` seeds users without state."""
    rows = (attach_vectors(actions, vectors, dims).filter(~F.col("skipped"))
            .select("user_id", "event_id", F.unix_micros("ts").alias("us"), "product_id", "product_vector", action_alpha(F.col("action_type")).alias("alpha")))
    seed = None if backup is None else backup.select(
        "user_id", F.col("preference_vector").cast("array<double>").alias("preference_vector"),
        F.coalesce("action_count", F.lit(1)).cast("bigint").alias("action_count")).groupBy("user_id")
    updates = rows.groupBy("user_id").transformWithStateInPandas(
        TasteProcessor(ttl_hours), OUTPUT, "Update", "None" if ttl_hours is None else "ProcessingTime", seed)
    return updates.withColumn("updated_at", F.timestamp_micros("updated_us")).drop("updated_us")
