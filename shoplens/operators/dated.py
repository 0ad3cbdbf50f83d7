"""Tables partitioned by day or hour: keyed tables that are merged partition by partition, and logs with bounded reads.

A keyed table lies in partitions (day of the row, hash bucket of its key) and holds one row per key, so a read of some days
opens these days alone and shuffles nothing. A batch is merged into the partitions it touches: those of its own rows, and
those in which their keys lie so far, which are found in the batch's buckets only. What a batch touched is written down
beside the data under its number, after the data; a batch that failed in between is delivered and merged again. Retention
removes whole days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators.tables import latest_per_key
from shoplens.session import durable, fits_broadcast

# Rows without a time lie in this day, which the first retention removes.
NO_DAY = dt.date(1900, 1, 1)
BUCKETS = 16
HOUR_US = 3_600_000_000


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _folder(spark, path)
    return fs.exists(at)


def partitions(spark: SparkSession, path: str, name: str) -> list[str]:
    """Values of the first partition column, from the names of the folders."""
    at, fs = _folder(spark, path)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{name}="))


def remove(spark: SparkSession, path: str) -> bool:
    at, fs = _folder(spark, path)
    return fs.delete(at, True)


@contextmanager
def take_lease(spark: SparkSession, path: str, older_than: float) -> Iterator[bool]:
    """Is the lease at `path` ours? It is a file that only one caller can make, and that goes when the block ends.

    One that was made before `older_than` (seconds of the epoch) was left by a caller that died, and is taken over.
    """
    at, fs = _folder(spark, path)
    if fs.exists(at) and fs.getFileStatus(at).getModificationTime() < older_than * 1000:
        fs.delete(at, False)
    mine = fs.createNewFile(at)
    try:
        yield mine
    finally:
        if mine:
            fs.delete(at, False)


def day_of(ts: str) -> Column:
    return F.coalesce(F.to_date(ts), F.lit(NO_DAY))


def _since_until(day: str, ts: str, since, until) -> Column:
    """Rows with since <= ts <= until, and the same of whole days, by which partitions are left out."""
    kept = F.lit(True)
    instant = lambda t: F.to_timestamp(F.lit(t.isoformat(sep=" ")))  # noqa: E731  in the session's zone
    if since is not None:
        kept &= (F.col(day) >= F.lit(since.date())) & (F.col(ts) >= instant(since))
    if until is not None:
        kept &= (F.col(day) <= F.lit(until.date())) & (F.col(ts) <= instant(until))
    return kept


def drop_before(spark: SparkSession, path: str, first: dt.date) -> list[str]:
    """Remove the partitions of all days before `first`; the days removed."""
    gone = [d for d in partitions(spark, path, "day") if d < first.isoformat()]
    for d in gone:
        remove(spark, f"{path}/day={d}")
    return gone


# ---- logs


def append_days(rows: DataFrame, path: str, ts: str, batch_id: int = 0) -> None:
    """Append a batch to a log in partitions (day, batch_id); the batch replaces itself in the days that it has rows of."""
    rows.withColumn("day", day_of(ts)).withColumn("batch_id", F.lit(batch_id)) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(path)


def read_days(spark: SparkSession, path: str, schema: T.StructType, ts: str, since: dt.datetime | None = None,
              until: dt.datetime | None = None) -> DataFrame:
    """Rows of a log or keyed table with since <= ts <= until; only their days are opened."""
    if not partitions(spark, path, "day"):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField("day", T.DateType())])).parquet(path)
    return table.where(_since_until("day", ts, since, until)).select(*schema.fieldNames())


# ---- keyed tables


@dataclass(frozen=True)
class KeyedTable:
    """Rows of `schema` with one row per `key`, the last by (batch, if `newest_batch_wins`, and) `order`, by day of `ts`.

    Rows without a key are all kept. The three columns day, bucket and batch_id are the table's own.
    """

    path: str
    schema: T.StructType
    key: str
    ts: str
    order: tuple[str, ...]
    buckets: int = BUCKETS
    newest_batch_wins: bool = True

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.key, [*(["batch_id"] if self.newest_batch_wins else []), *self.order])

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        if not partitions(spark, self.path, "day"):
            return None
        own = [T.StructField("batch_id", T.LongType()), T.StructField("day", T.DateType()), T.StructField("bucket", T.IntegerType())]
        return spark.read.schema(T.StructType([*self.schema.fields, *own])).parquet(self.path)

    def _within(self, touched: Iterable[tuple[dt.date, int]]) -> Column:
        """The partitions of a list, told day by day, as a filter that the scan can apply to folders."""
        days: dict[dt.date, list[int]] = {}
        for day, bucket in touched:
            days.setdefault(day, []).append(bucket)
        kept = F.lit(False)
        for day, some in sorted(days.items()):
            kept |= (F.col("day") == F.lit(day)) & F.col("bucket").isin(sorted(some))
        return kept

    def _note(self, batch_id: int) -> str:
        return f"{self.path}/_batches/batch_{batch_id}"

    def touched_by(self, spark: SparkSession, batch_id: int) -> set[tuple[dt.date, int]]:
        """Partitions that a batch has touched, by what was written down; none if it never ended."""
        note = self._note(batch_id)
        if not exists(spark, f"{note}/_SUCCESS"):
            return set()
        return {tuple(r) for r in spark.read.schema("day date, bucket int").json(note).collect()}

    def merge(self, rows: DataFrame, batch_id: int) -> None:
        """Merge a batch; the same batch again, an empty one too, first takes its own rows out."""
        spark = rows.sparkSession
        whole = [c for c, kind in rows.dtypes if c in self.schema.fieldNames() and not kind.startswith("map")]
        spread = F.when(F.col(self.key).isNull(), F.xxhash64(*whole)).otherwise(F.xxhash64(self.key))
        new = rows.select(*self.schema.fieldNames()).withColumn("batch_id", F.lit(batch_id).cast("long")) \
            .withColumn("day", day_of(self.ts)).withColumn("bucket", F.pmod(spread, F.lit(self.buckets)).cast("int"))
        new = durable(self._newest(new))
        # A list of partitions is bounded by the days kept times the buckets.
        places = lambda frame: {tuple(r) for r in frame.select("day", "bucket").distinct().collect()}
        touched = places(new) | self.touched_by(spark, batch_id)
        stored = self._stored(spark)
        merged = new
        if stored is not None:
            keys = new.where(F.col(self.key).isNotNull()).select(self.key, "bucket")
            keys = F.broadcast(keys) if fits_broadcast(keys, F.lit(64)) else keys
            touched |= places(stored.where(F.col("bucket").isin(sorted({b for _, b in touched}))).join(keys, [self.key, "bucket"], "left_semi"))
            if touched:
                old = stored.where(self._within(touched)).where(F.col("batch_id") != batch_id)
                # The partitions are written while they are read; what goes in is held elsewhere by then.
                merged = durable(self._newest(old.select(new.columns).unionByName(new)))
        if touched:
            merged.repartition("day", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy("day", "bucket").parquet(self.path)
            for day, bucket in touched - places(merged):
                remove(spark, f"{self.path}/day={day.isoformat()}/bucket={bucket}")
        spark.createDataFrame(sorted(touched), "day date, bucket int").coalesce(1).write.mode("overwrite").json(self._note(batch_id))

    def read(self, spark: SparkSession, since: dt.datetime | None = None, until: dt.datetime | None = None) -> DataFrame:
        """The current row of each key, of the days asked for."""
        return read_days(spark, self.path, self.schema, self.ts, since, until)


# ---- spans by the hour


def append_spans(spans: DataFrame, path: str, batch_id: int = 0) -> None:
    """Append a batch of spans to a log in partitions (hour of the start, batch_id)."""
    spans.withColumn("hour", F.call_function("div", F.col("start_us"), F.lit(HOUR_US))).withColumn("batch_id", F.lit(batch_id)) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hour", "batch_id").parquet(path)


def spans_of_batch(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """Spans that one batch has appended."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField("hour", T.LongType()), T.StructField("batch_id", T.LongType())])
    return spark.read.schema(whole).parquet(path).where(F.col("batch_id") == batch_id).select(*schema.fieldNames())


def spans_between(spark: SparkSession, path: str, schema: T.StructType, since_us: int, until_us: int, longest_us: int,
                  newest_batch: int | None = None) -> DataFrame:
    """Spans of all traces that may start in [since_us, until_us], from the hours in which they can lie.

    No trace may last longer than `longest_us`: then its other spans start at most so long before and after. Spans of traces
    that start earlier or later are among them; `traces_between` leaves these out and fails where a trace lasts longer.
    """
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField("hour", T.LongType()), T.StructField("batch_id", T.LongType())])).parquet(path)
    low, high = since_us - longest_us, until_us + longest_us
    rows = table.where(F.col("hour").between(low // HOUR_US, high // HOUR_US) & F.col("start_us").between(low, high))
    if newest_batch is not None:
        rows = rows.where(F.col("batch_id") <= newest_batch)
    return rows.select(*schema.fieldNames())


def traces_between(spans: DataFrame, since_us: int, until_us: int, longest_us: int) -> DataFrame:
    """(trace_id): the traces whose first span starts in [since_us, until_us]; a longer trace among them is an error."""
    length = F.max(F.col("start_us") + F.col("duration_us")) - F.min("start_us")
    found = spans.groupBy("trace_id").agg(F.min("start_us").alias("first"), length.alias("length"))
    too_long = F.raise_error(F.concat(F.lit("a trace lasts longer than the read-back: "), F.col("trace_id").cast("string")))
    return found.where(F.col("first").between(since_us, until_us)) \
        .where(F.when(F.col("length") > longest_us, too_long.cast("boolean")).otherwise(True)).select("trace_id")
