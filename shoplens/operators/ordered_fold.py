"""Sequential per-key folds that do not put a whole hot key into one task.

Some rules are order-dependent and have no partial aggregate (a taste vector that is normalised at every step, a
time-to-live gate). Keys of ordinary size are hashed to tasks and streamed in order with constant memory. A key with
more than `hot_rows` rows is range-partitioned by (key, order) instead, so that it is spread over many tasks, each
holding an ordered *segment*. Every segment is folded from a provisional start; the end of a segment is then the start
of the next one, and segments whose start changed are folded again until none changes. That fixpoint is the
sequential result. Both rules forget their past quickly, so two or three rounds are the normal case; in the worst case
every round settles at least one more segment of each key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.session import durable

HOT_ROWS = 2_000_000
_POSITION_BITS = 33  # monotonically_increasing_id = partition id << 33 | position


class Fold:
    """One rule. `state` is a dict of plain values matching `state_schema`, None before the first usable row."""

    state_schema: str
    output_schema: str | None = None  # schema of the rows that are passed on, if any
    additive: tuple[str, ...] = ()  # counters: kept per segment and summed at the end

    def load(self, batch: pa.RecordBatch):
        """The columns the rule reads, in a form that is cheap to slice."""
        raise NotImplementedError

    def step(self, state: dict | None, data, lo: int, hi: int) -> tuple[dict | None, list[int]]:
        """Fold rows `lo..hi` of one key, in order; returns the new state and the rows to pass on."""
        raise NotImplementedError

    def settled(self, old: DataFrame, new: DataFrame) -> "F.Column":
        """Condition under which the start states `o.*` and `n.*` count as equal."""
        raise NotImplementedError


def _runs(batch: pa.RecordBatch, keys: list[str]) -> list[tuple[tuple, int, int]]:
    """Maximal runs of equal keys as (key, first row, row after the last)."""
    n = batch.num_rows
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for key in keys:
        col = batch.column(key)
        if n > 1:
            change[1:] |= pc.not_equal(col.slice(1), col.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(change)
    at = pa.array(starts)
    values = zip(*[batch.column(k).take(at).to_pylist() for k in keys])
    starts = starts.tolist()
    return list(zip(values, starts, starts[1:] + [n]))


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _ddl(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def _states(fold: Fold, keys: list[str], out_schema: pa.Schema) -> Callable:
    """Arrow map: final state per key of a partition that is ordered by key."""
    state_cols = [f.name for f in out_schema][len(keys):]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, done = None, None, []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            data = fold.load(batch)
            for key, lo, hi in _runs(batch, keys):
                if key != current:
                    if state is not None:
                        done.append((current, state))
                    current, state = key, None
                state, _ = fold.step(state, data, lo, hi)
            if len(done) >= 1024:
                yield _state_batch(done, keys, state_cols, out_schema)
                done = []
        if state is not None:
            done.append((current, state))
        if done:
            yield _state_batch(done, keys, state_cols, out_schema)

    return run


def _state_batch(done, keys, state_cols, schema):
    columns = [pa.array([k[i] for k, _ in done], schema.field(i).type) for i in range(len(keys))]
    columns += [pa.array([s[c] for _, s in done], schema.field(c).type) for c in state_cols]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _outputs(fold: Fold, keys: list[str], out_schema: pa.Schema, state_cols: list[str]) -> Callable:
    """Arrow map: the rows passed on; a `_start_*` column that is set on the first row gives the start state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            data, kept = fold.load(batch), []
            for key, lo, hi in _runs(batch, keys):
                if key != current:
                    current, state = key, _start_of(batch, lo, state_cols)
                state, passed = fold.step(state, data, lo, hi)
                kept += passed
            yield batch.select(out_schema.names).take(pa.array(kept, pa.int64())).cast(out_schema)

    return run


def _start_of(batch: pa.RecordBatch, row: int, state_cols: list[str]) -> dict | None:
    if f"_start_{state_cols[0]}" not in batch.schema.names:
        return None
    start = {c: batch.column(f"_start_{c}")[row].as_py() for c in state_cols}
    return None if start[state_cols[0]] is None else start


def _segment_ends(fold: Fold, keys: list[str], out_schema: pa.Schema, state_cols: list[str]) -> Callable:
    """Arrow map over one segment: end state per key, with the segment and whether the key opens/closes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, segment, opens = None, None, None, True
        found = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            segment = batch.column("_rid")[0].as_py() >> _POSITION_BITS
            data = fold.load(batch)
            for key, lo, hi in _runs(batch, keys):
                if key != current:
                    if current is not None:
                        found.append((current, state, segment, opens, False))
                        opens = False
                    current, state = key, _start_of(batch, lo, state_cols)
                state, _ = fold.step(state, data, lo, hi)
        if current is None:
            return
        found.append((current, state, segment, opens, True))
        columns = [pa.array([f[0][i] for f in found], out_schema.field(i).type) for i in range(len(keys))]
        columns += [pa.array([f[1] and f[1][c] for f in found], out_schema.field(c).type) for c in state_cols]
        columns += [pa.array([f[i] for f in found], out_schema.field(name).type)
                    for i, name in ((2, "_segment"), (3, "_opens"), (4, "_closes"))]
        yield pa.RecordBatch.from_arrays(columns, schema=out_schema)

    return run


def hot_keys(rows: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Keys with more than `hot_rows` rows; at most (all rows / hot_rows) of them."""
    return rows.groupBy(*keys).count().filter(F.col("count") > hot_rows).select(*keys)


def ordered_fold(rows: DataFrame, keys: list[str], order: list[str], fold: Fold, *,
                 enrich: Callable[[DataFrame], DataFrame] = lambda df: df,
                 hot_rows: int = HOT_ROWS, segments: int | None = None) -> DataFrame:
    """Fold `rows` per key in `order`: final state per key, or the emitted rows if the rule has outputs.

    `enrich` adds columns after the shuffle; it must keep rows in place (a broadcast left join or a projection).
    """
    hot = durable(hot_keys(rows, keys, hot_rows))
    if hot.isEmpty():
        return _fold_small(rows, keys, order, fold, enrich)
    # One row per `hot_rows` rows at most, so the key list is small next to any executor.
    small = rows.join(F.broadcast(hot), keys, "left_anti")
    large = rows.join(F.broadcast(hot), keys, "left_semi")
    return _fold_small(small, keys, order, fold, enrich).unionByName(
        _fold_hot(large, keys, order, fold, enrich, hot_rows, segments))


def _fold_small(rows, keys, order, fold, enrich):
    # The sort comes last: below a join the optimizer would drop it.
    placed = enrich(rows.repartition(*keys)).sortWithinPartitions(*keys, *order)
    if fold.output_schema:
        return placed.mapInArrow(_outputs(fold, keys, _arrow_schema(fold.output_schema), _state_names(fold)),
                                 fold.output_schema)
    ddl = f"{_ddl(rows, keys)}, {fold.state_schema}"
    return placed.mapInArrow(_states(fold, keys, _arrow_schema(ddl)), ddl)


def _state_names(fold: Fold) -> list[str]:
    return _arrow_schema(fold.state_schema).names


def _fold_hot(rows, keys, order, fold, enrich, hot_rows, segments):
    state_cols = _state_names(fold)
    if segments is None:
        segments = max(2, rows.count() * 4 // hot_rows)
    laid_out = durable(rows.repartitionByRange(segments, *keys, *order).sortWithinPartitions(*keys, *order)
                       .withColumn("_rid", F.monotonically_increasing_id()))
    state_ddl = f"{_ddl(rows, keys)}, {fold.state_schema}, _segment long, _opens boolean, _closes boolean"
    run = _segment_ends(fold, keys, _arrow_schema(state_ddl), state_cols)

    def with_starts(data: DataFrame, starts: DataFrame | None) -> DataFrame:
        data = enrich(data)
        if starts is None:
            return data
        # One row per segment: a fixed, small number.
        heads = starts.select(F.shiftleft("_segment", _POSITION_BITS).alias("_rid"),
                              *[F.col(c).alias(f"_start_{c}") for c in state_cols])
        return data.join(F.broadcast(heads), "_rid", "left")

    ends = durable(with_starts(laid_out, None).mapInArrow(run, state_ddl))
    openers = ends.filter("_opens").select("_segment", *keys)
    # One row per segment; range bounds may leave partitions empty, hence the next filled one.
    following = openers.select("_segment", F.lead("_segment").over(Window.orderBy("_segment")).alias("_next"))
    starts = None
    for _ in range(segments + 1):
        proposed = durable(ends.filter("_closes").join(following, "_segment")
                           .withColumn("_segment", F.col("_next"))
                           .withColumns({c: F.lit(0).cast(ends.schema[c].dataType) for c in fold.additive})
                           .join(openers, ["_segment", *keys], "left_semi").select("_segment", *keys, *state_cols)
                           .filter(F.col(state_cols[0]).isNotNull()))
        if starts is None:
            changed = proposed.select("_segment")
        else:
            o, n = starts.alias("o"), proposed.alias("n")
            changed = (n.join(o, F.col("n._segment") == F.col("o._segment"), "left")
                       .filter(F.col("o._segment").isNull() | ~F.coalesce(fold.settled(o, n), F.lit(False)))
                       .select(F.col("n._segment").alias("_segment")))
        changed = durable(changed)
        if changed.isEmpty():
            break
        starts = proposed
        segment = F.shiftright("_rid", _POSITION_BITS)
        again = laid_out.withColumn("_segment", segment).join(F.broadcast(changed), "_segment", "left_semi").drop("_segment")
        ends = durable(ends.join(F.broadcast(changed), "_segment", "left_anti").unionByName(
            with_starts(again, starts).mapInArrow(run, state_ddl)))
    if fold.output_schema:
        return with_starts(laid_out, starts).mapInArrow(
            _outputs(fold, keys, _arrow_schema(fold.output_schema), state_cols), fold.output_schema)
    last = ends.filter(F.col(state_cols[0]).isNotNull()).groupBy(*keys).agg(
        F.max_by(F.struct(*[c for c in state_cols if c not in fold.additive]), "_segment").alias("s"),
        *[F.sum(c).alias(c) for c in fold.additive])
    return last.select(*keys, "s.*", *fold.additive).select(*keys, *state_cols)
