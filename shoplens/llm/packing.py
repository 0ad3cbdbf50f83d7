"""Packing documents into sequences of fixed length by sums of squares.

A piece is placed where the sum, over all gaps, of the squared number of open sequences with that gap becomes smallest, so
sequences that no piece may ever fill are not opened in numbers. Pieces are dealt at random into groups of bounded size, and
each group is packed by one task, the longest pieces first. Pieces of sequences that stay open go on to a next round in
which those of all groups are dealt anew, until one group holds the rest or a round fills less than half of what it got.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType
from tokenizers import Tokenizer

from shoplens.llm.common import fresh, text_or_empty, worker_state
from shoplens.llm.tokenstore import WordEncoder
from shoplens.session import durable

SIZE = 2048
# Pieces packed together; gap up to which a sequence counts as full before the last round.
GROUP, SLACK = 8192, 8
# Numbers for the sequences of a group.
NUMBERS = 1 << 24
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


# ---- one group


def sum_of_squares(lengths: list[int], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, taken in the given order, and the gap that each sequence is left with.

    Placing a piece of length x in one of N(g) sequences with gap g takes 2 N(g) - 1 from the sum and adds 2 N(g - x) + 1,
    unless that gap is 0; a new sequence takes nothing. Of equal places, the one with the smallest gap is taken.
    """
    taken = np.full(size + 1, 1 << 60, np.int64)
    taken[size] = 0
    added = np.ones(size + 1, np.int64)
    added[0] = 0
    open_at: list[list[int]] = [[] for _ in range(size + 1)]
    where, offset, gaps = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    for k, x in enumerate(lengths):
        gap = x + int((taken[x:] + added[:size + 1 - x]).argmin())
        if gap == size:
            number = len(gaps)
            gaps.append(0)
        else:
            number = open_at[gap].pop()
            added[gap] -= 2
            taken[gap] = 1 - 2 * len(open_at[gap]) if open_at[gap] else 1 << 60
        left = gap - x
        where[k], offset[k], gaps[number] = number, size - gap, left
        if left:
            open_at[left].append(number)
            added[left] += 2
            taken[left] = 1 - 2 * len(open_at[left])
    return where, offset, np.array(gaps, np.int64)


def _packing(size: int, slack: int, group: str, length: str, names: list[str]):
    """Over rows sorted by group: each group's rows with their sequence and offset, and whether the sequence is full."""

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        where, offset, gaps = sum_of_squares(rows.column(length).to_pylist(), size)
        number = rows.column(group).to_numpy() * NUMBERS + where
        for name, values in zip(names, (number, offset, gaps[where] <= slack)):
            rows = rows.append_column(name, pa.array(values))
        yield from rows.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            keys = batch.column(group).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and keys[a] != key:
                    yield from packed(held)
                    held = []
                key = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from packed(held)

    return run


# ---- jobs


def pieces(docs: DataFrame, tokenizer_file: str, end_id: int, size: int = SIZE, keep_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): the documents' ids with `end_id`, cut where they are longer than `size`.

    All pieces of a longer document are `size` long but for the first. `ids` holds packed little-endian 32-bit ids, null
    unless `keep_ids`. A null or empty text is its `end_id` alone; null ids and repeated rows stay as they are.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def cut(packed: bytes) -> Iterator[tuple[int, bytes]]:
        n = len(packed) // 4
        start = 0
        while start < n:
            end = start + ((n - start - 1) % size + 1)
            yield start, packed[4 * start:4 * end]
            start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state("packing")
        for batch in batches:
            if shared.value not in state:
                state.clear()
                state[shared.value] = WordEncoder(shared.value, 4)
            encoded = state[shared.value].encode(batch.column("text").to_pylist())
            rows = [(key, k, start, len(ids) // 4, zlib.crc32(ids), ids if keep_ids else None)
                    for key, packed in zip(batch.column("doc_id").to_pylist(), encoded)
                    for k, (start, ids) in enumerate(cut(packed + end_id.to_bytes(4, "little")))]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = [f.split()[0] for f in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, PIECES)


def pack(items: DataFrame, size: int = SIZE, group: int = GROUP, slack: int = SLACK) -> DataFrame:
    """`items`, whose `length` is between 1 and `size`, with sequence_id and offset.

    Sequences have no gaps between their items. Equal rows are items of their own; other columns are carried along, and those
    named sequence_id or offset are replaced. An empty table gives none. Another length is an error.
    """
    items = items.drop("sequence_id", "offset")
    row, key, done = fresh([*items.columns, "sequence_id", "offset"], "_row", "_group", "_done")
    bad = F.col("length").isNull() | ~F.col("length").between(1, size)
    length = F.when(bad, F.raise_error(F.lit(f"length must be from 1 to {size}"))).otherwise(F.col("length"))
    rows = durable(items.withColumn("length", length).withColumn(row, F.monotonically_increasing_id()))
    full = F.col("length") == size
    packed = rows.where(full).withColumn("sequence_id", -1 - F.col(row)).withColumn("offset", F.lit(0).cast("long"))
    left, base, turn = rows.where(~full), 0, 0
    n = left.count()
    while n:
        groups = -(-n // group)
        dealt = left.withColumn(key, F.pmod(F.xxhash64(F.lit(turn), row), F.lit(groups)).cast("long"))
        names = ["sequence_id", "offset", done]
        schema = StructType([*dealt.schema.fields, StructField(names[0], LongType()), StructField(names[1], LongType()), StructField(done, BooleanType())])
        parts = min(groups, int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        told = dealt.repartition(max(parts, -(-groups // 8)), key).sortWithinPartitions(key, F.desc("length"), row) \
            .mapInArrow(_packing(size, slack, key, "length", names), schema)
        told = durable(told.withColumn("sequence_id", F.col("sequence_id") + base))
        rest = told.where(~F.col(done))
        m = rest.count() if groups > 1 else 0
        last = groups == 1 or m > n // 2
        packed = packed.unionByName((told if last else told.where(done)).select(packed.columns))
        if last:
            break
        left, base, turn, n = rest.select(left.columns), base + groups * NUMBERS, turn + 1, m
    return packed.drop(row)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n, ids): the ids of each sequence's pieces in their places; at most `size` ids each."""
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p")) \
        .select("sequence_id", "n", F.aggregate("p", F.lit(b""), lambda all_ids, p: F.concat(all_ids, p["ids"])).alias("ids"))


def report(docs: DataFrame, tokenizer_file: str, end_id: int = 0) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    return pack(pieces(docs.select("doc_id", "text"), tokenizer_file, end_id, keep_ids=False).drop("ids"))
