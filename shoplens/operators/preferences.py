"""Per-user taste vectors: attaching product vectors, the sequential fold, versions and fall-back lookup."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.actions import action_alpha
from shoplens.functions.vectors import has_vector
from shoplens.operators.ordered_fold import HOT_ROWS, Fold, ordered_fold
from shoplens.session import BROADCAST_LIMIT_BYTES, fits_broadcast

STATE_TTL_HOURS = 24


def attach_vectors(actions: DataFrame, vectors: DataFrame, dims: int) -> DataFrame:
    """Actions with the vector of their product; `skipped` where it is missing or of the wrong length.

    A small catalogue is broadcast, so nothing is shuffled. Otherwise Spark joins by product and splits hot products
    at run time (adaptive skew join).
    """
    usable = vectors.filter(has_vector(F.col("product_vector"), dims)).select("product_id", "product_vector")
    if fits_broadcast(usable, F.size("product_vector") * 4 + 24):
        usable = F.broadcast(usable)
    return (actions.join(usable, "product_id", "left")
            .withColumn("skipped", F.col("product_vector").isNull()))


class TasteFold(Fold):
    """Exponential moving average of product vectors, normalised after every step.

    The first usable action sets the vector whatever its rate; rate 0 leaves a vector as it is but is counted.
    """

    state_schema = "preference_vector array<double>, action_count bigint"
    additive = ("action_count",)

    def __init__(self, tolerance: float = 1e-12):
        self.tolerance = tolerance  # far below the 32-bit resolution of stored vectors

    def load(self, batch):
        column = batch.column("product_vector")
        present = column.is_valid().to_numpy(zero_copy_only=False)
        vectors = column.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        alphas = batch.column("alpha").to_numpy(zero_copy_only=False)[present].tolist()
        # Row i of the batch is usable row `before[i]`, if it is usable at all.
        before = np.concatenate([[0], np.cumsum(present)])
        return vectors.reshape(max(len(alphas), 1), -1), alphas, before

    def step(self, state, data, lo, hi):
        vectors, alphas, before = data
        at, end = int(before[lo]), int(before[hi])
        if at == end:
            return state, []
        if state is None:
            v, count = _unit(vectors[at]), 1
            at += 1
        else:
            v, count = np.asarray(state["preference_vector"]), state["action_count"]
        for i in range(at, end):
            a = alphas[i]
            if a:
                v = _unit((1.0 - a) * v + a * vectors[i])
        return {"preference_vector": v, "action_count": count + end - at}, []

    def settled(self, old, new):
        return F.aggregate(
            F.zip_with("o.preference_vector", "n.preference_vector", lambda x, y: F.abs(x - y)),
            F.lit(0.0), lambda m, d: F.greatest(m, d)) <= self.tolerance


def _unit(v: np.ndarray) -> np.ndarray:
    length = np.sqrt(v @ v)
    return v / length if length > 0 else v


def preference_fold(actions: DataFrame, vectors: DataFrame, dims: int, *, order: tuple[str, ...] = ("ts", "event_id"),
                    hot_rows: int = HOT_ROWS, segments: int | None = None) -> DataFrame:
    """Taste vector and action count per user: `actions(user_id, product_id, action_type, *order)`.

    Only (user, product, rate, order) is shuffled when the catalogue is small: its vectors are joined in afterwards,
    map-side. A large catalogue is joined first. A user with a huge history is split, see `ordered_fold`.
    """
    usable = vectors.filter(has_vector(F.col("product_vector"), dims)).select("product_id", "product_vector")
    slim = actions.select("user_id", "product_id", action_alpha(F.col("action_type")).alias("alpha"), *order)
    if fits_broadcast(usable, F.size("product_vector") * 4 + 24, BROADCAST_LIMIT_BYTES):
        return ordered_fold(slim, ["user_id"], list(order), TasteFold(), hot_rows=hot_rows, segments=segments,
                            enrich=lambda df: df.join(F.broadcast(usable), "product_id", "left"))
    return ordered_fold(slim.join(usable, "product_id"), ["user_id"], list(order), TasteFold(),
                        hot_rows=hot_rows, segments=segments)


def preference_fold_in_arrays(actions: DataFrame, vectors: DataFrame, dims: int,
                              order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """The same fold with array functions only. It gathers each user's history: for short histories and tests."""
    from shoplens.functions.vectors import ema_step

    usable = vectors.filter(has_vector(F.col("product_vector"), dims))
    rows = actions.join(usable, "product_id").select(
        "user_id", F.struct(*order, action_alpha(F.col("action_type")).alias("alpha"),
                            F.col("product_vector").cast("array<double>").alias("p")).alias("r"))
    history = rows.groupBy("user_id").agg(F.sort_array(F.collect_list("r")).alias("h"))
    return history.select(
        "user_id",
        F.aggregate("h", F.lit(None).cast("array<double>"),
                    lambda v, r: ema_step(v, r["p"], r["alpha"])).alias("preference_vector"),
        F.size("h").cast("bigint").alias("action_count"))


def newest_version(stored: DataFrame, incoming: DataFrame, key: str, version: str) -> DataFrame:
    """Versioned write: an incoming row wins only with a strictly newer version; among equals the stored/first wins.

    Rows need a `seq` that orders the incoming ones. One map-side combined aggregation.
    """
    columns = [c for c in stored.columns]
    both = (stored.select(*columns, F.lit(1).alias("_old"), F.lit(0).cast("bigint").alias("_seq"))
            .unionByName(incoming.select(*columns, F.lit(0).alias("_old"), F.col("seq").cast("bigint").alias("_seq"))))
    best = both.groupBy(key).agg(F.max_by(
        F.struct(*[c for c in columns if c != key]),
        F.struct(F.col(version), F.col("_old"), -F.col("_seq"))).alias("_row"))
    return best.select(key, "_row.*")


def preference_with_fallback(users: DataFrame, primary: DataFrame, backup: DataFrame, as_of: Column,
                             ttl_hours: int = STATE_TTL_HOURS) -> DataFrame:
    """Preference of each user: the primary row while fresh, else the backup (count 1 if unknown), else none."""
    fresh = primary.filter(F.col("updated_at") > as_of - F.expr(f"INTERVAL {ttl_hours} HOURS")).select(
        "user_id", F.struct("preference_vector", "action_count").alias("_p"))
    saved = backup.select("user_id", F.struct(
        "preference_vector", F.coalesce("action_count", F.lit(1)).cast("bigint").alias("action_count")).alias("_b"))
    joined = users.join(fresh, "user_id", "left").join(saved, "user_id", "left")
    chosen = F.coalesce(F.col("_p"), F.col("_b"))
    return joined.select(
        "user_id", chosen["preference_vector"].alias("preference_vector"),
        chosen["action_count"].alias("action_count"),
        F.when(F.col("_p").isNotNull(), "primary").when(F.col("_b").isNotNull(), "backup")
         .otherwise("none").alias("source"))
