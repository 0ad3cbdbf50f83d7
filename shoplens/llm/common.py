"""What the operators of this folder share: limits of Arrow batches, state of Python workers, keys of rows."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from shoplens import session

# Bounds the memory of a Python worker whatever the length of the texts.
BATCH_ROWS, BATCH_BYTES = 1000, 8 * 1024 * 1024

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on, and bound the batches handed to Python."""
    session.prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def worker_state(name: str) -> dict:
    """A dictionary that lives in the Python worker until another operator asks for its own, for tables that are costly to build.

    Workers serve one job after the other; what an earlier operator has built must not take the memory of the next. So an
    operator that keeps nothing asks as well, at the start of a task.
    """
    holder = sys.modules.setdefault("_shoplens_worker_state", types.ModuleType("_shoplens_worker_state")).__dict__.setdefault("states", {})
    if name not in holder:
        holder.clear()
    return holder.setdefault(name, {})


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def fresh(columns: list[str], *wanted: str) -> list[str]:
    """Names like the wanted ones that clash with none of the columns."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
