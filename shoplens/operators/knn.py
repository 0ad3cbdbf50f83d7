"""Exact nearest products per user, searched block by block from the nearest on, against the k-th score found so far.

Products are grouped around pivots into blocks of bounded size. For a user, the angle to a block's pivot and the block's
radius bound the angle to every product in it (triangle inequality on the sphere). Each user first goes to the blocks that
may hold its nearest products, then to a few more, then to the rest, in each round only to blocks whose bound beats the
k-th score that the rounds before have found. Blocks travel in groups as large as a task can hold, and a user goes once a
round to each group that holds blocks of its own, with a bit for each block: however small blocks are, no vector of a user
is copied for each of them. In a (group, user chunk) pair each block is scored by a matrix product with the users that asked
for it, and k rows per user are kept. No pair of user and product is ever emitted, and the result is the exact one whatever
the pivots are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.vectors import has_vector, l2_normalize
from shoplens.operators.topk import top_per_group
from shoplens.session import durable

BLOCK_BYTES = 64 * 1024 * 1024  # of either side of a group pair
MIN_CHUNK_USERS = 1024
MAX_PIVOTS = 4096
# Vectors sampled for each pivot, and the rounds in which pivots move to the middle of those nearest to them.
PIVOT_SAMPLE, PIVOT_ROUNDS = 16, 5
# Blocks of the second round; the first takes as many as hold k products, the third what is left.
SECOND_ROUND = 8
_SLACK = 1e-5  # of angles
_ROUNDING = 1e-9  # of scores from a matrix product; what may be among the best is scored again, row by row
_PARTS = 1_000_000  # numbers for the parts of a crowded pivot
_CELLS, _FOUND = 4_000_000, 100_000  # scores in one matrix product, rows that it may find


def knn_candidates(goods: DataFrame, dims: int, category: str | None = None) -> DataFrame:
    """Products that may be recommended: in stock, with a usable vector, of the category if one is given."""
    kept = goods.filter((F.col("stock") > 0) & has_vector(F.col("product_vector"), dims))
    if category is not None:
        kept = kept.filter(F.col("category") == category)
    return kept.select("product_id", F.col("product_vector").cast("array<float>").alias("vector"))


def knn_join(users: DataFrame, candidates: DataFrame, k: int, dims: int, *, block_rows: int | None = None,
             chunk_users: int | None = None, stats: dict | None = None) -> DataFrame:
    """The `k` best candidates of each user: (user_id, product_id, score, rank), by the unrounded score, then the id.

    `users(user_id, preference_vector, exclude)`: `exclude` is the bounded list of product ids not to return.
    A product is sent to every chunk of users; both sides are cut as large as a task can hold, so that the fewest copies
    are made, but small enough to keep all cores busy. `stats` is told how many pairs there are and how many were scored.
    """
    held = max(256, BLOCK_BYTES // (dims * 8))
    block_rows = block_rows or held
    units = durable(users.select("user_id", l2_normalize(F.col("preference_vector")).alias("unit"), "exclude"))
    candidates = durable(candidates)
    n_users, n_goods = units.count(), candidates.count()
    if chunk_users is None:
        share = math.ceil(n_users / users.sparkSession.sparkContext.defaultParallelism)
        chunk_users = min(max(share, MIN_CHUNK_USERS), held)
    chunks = max(1, math.ceil(n_users / chunk_users))
    # Parts of a pivot tell no more apart than the pivot does: smaller ones than a table of bounded size needs only cost.
    block_rows = max(block_rows, min(held, math.ceil(n_goods / MAX_PIVOTS)))
    pivots = min(MAX_PIVOTS, math.ceil(n_goods / block_rows))
    units = units.withColumn("chunk", F.pmod(F.xxhash64("user_id"), F.lit(chunks))).withColumn("least", F.lit(None).cast("double"))
    order = [F.desc("score"), F.asc("product_id")]
    if stats is not None:
        stats |= {"pairs": n_users * n_goods, "scored": n_users * n_goods}
    if pivots <= 1:
        zero = F.lit(0).cast("bigint")
        routed = units.withColumn("group", zero).withColumn("targets", F.lit(_bits(np.ones(1, bool))))
        return top_per_group(_scored(routed, candidates.withColumn("at", zero).withColumn("group", zero), chunks, k), ["user_id"], order, k)
    # Enough groups for all cores where there are few chunks of users.
    least_groups = math.ceil(users.sparkSession.sparkContext.defaultParallelism / chunks)
    goods, blocks = _place(candidates, pivots, block_rows, min(held, math.ceil(n_goods / least_groups)))
    best, state, scored = None, units.withColumn("sent", F.lit(_bits(np.zeros(len(blocks["members"]), bool)))), 0
    for turn in range(3):
        told = durable(_choose(state, blocks, k, turn))
        routed = told.withColumn("group", F.explode("groups")).drop("sent", "groups", "pairs")
        if stats is not None:
            scored += told.agg(F.sum("pairs")).first()[0] or 0
            stats["scored"] = scored
        if turn and told.where(F.size("groups") > 0).isEmpty():
            break
        found = _scored(routed, goods, chunks, k)
        best = durable(top_per_group(found if best is None else found.unionByName(best.drop("rank")), ["user_id"], order, k))
        least = best.groupBy("user_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k).select("user_id", "least")
        state = told.select("user_id", "unit", "exclude", "chunk", "sent").join(least, "user_id", "left") \
            .select("user_id", "unit", "exclude", "chunk", "least", "sent")
    return best


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _units(column) -> np.ndarray:
    """Rows of length 1, in 64-bit floats; a zero vector stays as it is."""
    matrix = _matrix(column).astype(np.float64)
    lengths = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(lengths > 0, lengths, 1.0)


def _bits(flags: np.ndarray) -> bytes:
    """A bit for each block."""
    return np.packbits(flags).tobytes()


def _flags(bits, many: int) -> np.ndarray:
    """Rows of the first `many` bits of each value."""
    packed = np.frombuffer(b"".join(bits.to_pylist()), np.uint8).reshape(len(bits), -1)
    return np.unpackbits(packed, axis=1, count=many).view(bool)


def _scored(routed: DataFrame, goods: DataFrame, chunks: int, k: int) -> DataFrame:
    """(user_id, product_id, score): the best of each user in each group of blocks that it was sent to."""
    copies = goods.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))))
    user, product = _kind(routed, "user_id"), _kind(goods, "product_id")
    return (routed.groupBy("group", "chunk").cogroup(copies.groupBy("group", "chunk"))
            .applyInArrow(_score_group(k), f"user_id {user}, product_id {product}, score double"))


def _score_group(k: int):
    """Scorer of one (users, products) group pair; keeps the best `k` per user that reach its `least` score."""

    def score(users: pa.Table, goods: pa.Table) -> pa.Table:
        out_users, out_goods, out_scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if users.num_rows and goods.num_rows:
            goods = goods.take(pa.array(np.argsort(goods.column("at").to_numpy(), kind="stable")))
            at = goods.column("at").to_numpy()
            blocks, starts = np.unique(at, return_index=True)
            stops = np.append(starts[1:], len(at))
            # Ids of any type: their order is kept as numbers.
            ids = goods.column("product_id").to_numpy()
            matrix = _units(goods.column("vector"))
            by_id = np.argsort(ids, kind="stable")
            order = np.empty(len(ids), np.int64)
            order[by_id] = np.arange(len(ids))
            sorted_ids = ids[by_id]
            again = np.zeros(len(ids), bool)  # an id that the block has had
            again[by_id[1:]] = (sorted_ids[1:] == sorted_ids[:-1]) & (at[by_id[1:]] == at[by_id[:-1]])
            taste = _matrix(users.column("unit"))
            least = users.column("least").fill_null(-1.0).to_numpy() - _ROUNDING
            excludes, targets = users.column("exclude").combine_chunks(), users.column("targets").combine_chunks()
            step = max(1, 8 * _CELLS // (int(blocks[-1]) + 1))
            for lo in range(0, len(taste), step):
                part, floors = taste[lo:lo + step], least[lo:lo + step].copy()
                asked = _flags(targets.slice(lo, len(part)), int(blocks[-1]) + 1)
                some = excludes.slice(lo, len(part))
                banned = some.flatten().to_numpy(zero_copy_only=False)
                whose = np.repeat(np.arange(len(part)), some.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                if len(banned):
                    low = np.searchsorted(sorted_ids, banned)
                    many = np.searchsorted(sorted_ids, banned, "right") - low
                    whose = np.repeat(whose, many)
                    spots = by_id[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())]
                    by = np.argsort(spots, kind="stable")
                    by = by[~again[spots[by]]]
                    whose, spots = whose[by], spots[by]
                else:
                    whose, spots = np.zeros(0, np.int64), np.zeros(0, np.int64)
                place = np.full(len(part), -1)
                held, size = [], 0

                def best():
                    row, near, exact = (np.concatenate(x) for x in zip(*held))
                    by = np.lexsort((order[near], -exact, row))
                    row, near, exact = row[by], near[by], exact[by]
                    rank = np.arange(len(row)) - np.searchsorted(row, row)
                    last = rank == k - 1
                    floors[row[last]] = np.maximum(floors[row[last]], exact[last] - _ROUNDING)
                    return row[rank < k], near[rank < k], exact[rank < k]

                for block, start, stop in zip(blocks.tolist(), starts.tolist(), stops.tolist()):
                    rows = np.flatnonzero(asked[:, block])
                    first, last = np.searchsorted(spots, [start, stop])
                    span = max(1, min(_CELLS // (stop - start), _FOUND // k))
                    for mine in (rows[r:r + span] for r in range(0, len(rows), span)):
                        scores = (1.0 + part[mine] @ matrix[start:stop].T) / 2.0
                        if last > first:
                            place[mine] = np.arange(len(mine))
                            line = place[whose[first:last]]
                            scores[line[line >= 0], spots[first:last][line >= 0] - start] = -1.0
                            place[mine] = -1
                        floor = np.maximum(floors[mine], -0.5)
                        if stop - start > k:
                            floor = np.maximum(floor, np.partition(scores, stop - start - k, axis=1)[:, stop - start - k] - _ROUNDING)
                        row, near = np.nonzero(scores >= floor[:, None])
                        row, near = mine[row], near + start
                        # Equal vectors get equal scores here, whatever their places in the matrix.
                        held.append((row, near, (1.0 + (matrix[near] * part[row]).sum(axis=1)) / 2.0))
                        size += len(row)
                    if size > 10 * _FOUND + 4 * k * len(part):
                        held = [best()]
                        size = len(held[0][0])
                if held:
                    row, near, exact = best()
                    out_users.append(row + lo)
                    out_goods.append(near)
                    out_scores.append(exact)
        return pa.table({
            "user_id": users.column("user_id").take(pa.array(np.concatenate(out_users))),
            "product_id": goods.column("product_id").take(pa.array(np.concatenate(out_goods))),
            "score": pa.array(np.concatenate(out_scores))})

    return score


def _centres(candidates: DataFrame, pivots: int) -> np.ndarray:
    """Pivots: unit vectors of a sample of bounded size (those with the smallest hashes), moved to the middle of their own."""
    sample = _units(candidates.orderBy(F.xxhash64("product_id"), "product_id").limit(pivots * PIVOT_SAMPLE).select("vector").toArrow().column("vector"))
    centres = sample[:pivots].copy()
    for _ in range(PIVOT_ROUNDS):
        nearest = np.concatenate([(sample[at:at + 4096] @ centres.T).argmax(axis=1) for at in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        lengths = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1.0), centres)
    return centres


def _place(candidates: DataFrame, pivots: int, block_rows: int, group_rows: int) -> tuple[DataFrame, dict[str, np.ndarray]]:
    """Products with their block's place and group, and the table of blocks: members, group, centre and radius of each."""
    centres = _centres(candidates, pivots)
    shared = candidates.sparkSession.sparkContext.broadcast(centres)

    def assign(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cos = _units(b.column("vector")) @ shared.value.T
            nearest = cos.argmax(axis=1)
            angle = np.arccos(np.clip(cos[np.arange(len(cos)), nearest], -1.0, 1.0))
            yield pa.RecordBatch.from_arrays(
                [b.column("product_id"), b.column("vector"), pa.array(nearest, pa.int64()), pa.array(angle)],
                names=["product_id", "vector", "pivot", "angle"])

    product = _kind(candidates, "product_id")
    placed = durable(candidates.mapInArrow(assign, f"product_id {product}, vector array<float>, pivot bigint, angle double"))
    # A crowded pivot is cut into parts by hash, each of which is a block of its own; the table of pivots is bounded.
    sizes = placed.groupBy("pivot").agg(F.ceil(F.count("*") / block_rows).alias("parts"))
    placed = placed.join(F.broadcast(sizes), "pivot") \
        .withColumn("block", F.col("pivot") * _PARTS + F.pmod(F.xxhash64("product_id"), "parts"))
    table = placed.groupBy("block").agg(F.count("*").alias("members"), F.max("angle").alias("radius")).orderBy("block").toArrow()
    number = table.column("block").to_numpy()
    members = table.column("members").to_numpy()
    group = (np.cumsum(members) - 1) // max(1, group_rows)
    rows = list(zip(number.tolist(), range(len(number)), group.tolist()))
    places = candidates.sparkSession.createDataFrame(rows, "block bigint, at bigint, group bigint")
    return placed.join(F.broadcast(places), "block").select("product_id", "vector", "at", "group"), {
        "members": members, "group": group, "radius": table.column("radius").to_numpy(), "centre": centres[number // _PARTS]}


def _choose(state: DataFrame, blocks: dict[str, np.ndarray], k: int, turn: int) -> DataFrame:
    """`state` with a bit for each block in `targets`: those of this round that the user hasn't been sent to and that can hold
    one of its best. `sent` has the bits of all rounds, `groups` the groups of the targets, `pairs` their products.
    """
    shared = state.sparkSession.sparkContext.broadcast(blocks)

    def chosen(batch):
        members, group, radius, centre = (shared.value[c] for c in ("members", "group", "radius", "centre"))
        theta = np.arccos(np.clip(_matrix(batch.column("unit")) @ centre.T, -1.0, 1.0))
        before = _flags(batch.column("sent"), len(members))
        excluded = [len(e or ()) for e in batch.column("exclude").to_pylist()]
        targets = np.zeros_like(before)
        for angles, gone, sent, least, mine in zip(theta, excluded, before, batch.column("least").to_pylist(), targets):
            low, far = angles - radius, angles + radius
            # Enough products lie within this angle, whatever has been scored.
            by_far = np.argsort(far)
            enough = np.searchsorted(np.cumsum(members[by_far]), k + gone)
            limit = far[by_far[enough]] if enough < len(far) else np.pi
            if least is not None:
                limit = min(limit, math.acos(max(-1.0, min(1.0, 2 * least - 1 - 4 * _ROUNDING))))
            near = np.flatnonzero((low <= limit + _SLACK) & ~sent)
            near = near[np.argsort(low[near], kind="stable")]
            if turn == 0:
                near = near[:int(np.searchsorted(np.cumsum(members[near]), k + gone)) + 1]
            elif turn == 1:
                near = near[:SECOND_ROUND]
            mine[near] = True
        columns = dict(zip(batch.schema.names, batch.columns)) | {
            "sent": pa.array([_bits(x) for x in before | targets], pa.binary()), "targets": pa.array([_bits(x) for x in targets], pa.binary()),
            "groups": pa.array([np.unique(group[x]).tolist() for x in targets], pa.list_(pa.int64())), "pairs": pa.array(targets @ members)}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def choose(batches):
        for b in batches:
            step = max(1, _CELLS // len(shared.value["members"]))
            for lo in range(0, b.num_rows, step):
                yield chosen(b.slice(lo, step))

    user, exclude = _kind(state, "user_id"), _kind(state, "exclude")
    return state.mapInArrow(choose, f"user_id {user}, unit array<double>, exclude {exclude}, chunk bigint, least double, "
                                    "sent binary, targets binary, groups array<bigint>, pairs bigint")
