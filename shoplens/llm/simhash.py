"""SimHash fingerprints, their near pairs through a Gray-order hierarchical index, and the groups they form.

Fingerprints are dealt out by blocks of bits: with radius r they are cut in r + 1 blocks, and a pair that differs in r
bits or fewer agrees on a block. The distinct fingerprints that share a block form a bucket; a bucket with more than
`BUCKET` of them is dealt again by blocks of its remaining bits, as often as needed, so that no task meets an unbounded
one. In a bucket the fingerprints are sorted by Gray rank, neighbours share most bits, and each upper node of the index
keeps the bits that all below it share. A search adds up the differences from the root downwards and drops a node as
soon as they exceed the radius. A bucket gives a spanning forest of its links, not the links themselves, so its output
is smaller than its input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import fresh, text_or_empty, worker_state
from shoplens.llm.decontaminate import maybe_broadcast
from shoplens.session import durable

BITS = 64
ALL = (1 << BITS) - 1
SEED = 42
# Largest bucket searched in one piece, children of a node, queries searched at once.
BUCKET, FAN, QUERIES = 512, 8, 512
LONG_TEXT = 1 << 16


# ---- fingerprints


def fingerprint(text: str, words: int) -> bytes:
    """Big-endian fingerprint over the text's word shingles; zero for a text without words."""
    w = text.encode().lower().split()
    if not w:
        return bytes(8)
    joined = b" ".join(w)
    if len(w) <= words:
        return xxhash.xxh64_digest(joined, SEED)
    length = np.fromiter(map(len, w), np.int64, len(w))
    ends = np.cumsum(length) + np.arange(len(w))
    starts = (ends - length)[:len(w) - words + 1].tolist()
    digest = xxhash.xxh64_digest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1:].tolist())]
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), LONG_TEXT):
        part = np.frombuffer(b"".join(hashes[at:at + LONG_TEXT]), np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(votes * 2 > len(hashes)).tobytes()


def fingerprints(text: str | Column = "text", words: int = 3) -> Column:
    """Fingerprint of a text as a signed long; null counts as empty."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_state("simhash")
        for texts in batches:
            packed = b"".join([fingerprint(t, words) for t in texts.to_pylist()])
            yield pa.array(np.frombuffer(packed, ">u8").astype(np.uint64).view(np.int64), pa.int64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "long")(text_or_empty(text))


# ---- the index of one bucket


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence, in which neighbours differ by one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Levels from the codes upwards: the bits that a node adds to those of its parent, and which bits these are."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        pattern, mask = self.codes, np.full(len(codes), ALL, np.uint64)
        self.levels = []
        while True:
            starts = np.arange(0, len(pattern), FAN)
            first = np.repeat(pattern[starts], np.diff(np.append(starts, len(pattern))))
            shared = np.bitwise_and.reduceat(mask, starts) & ~np.bitwise_or.reduceat(pattern ^ first, starts)
            top = len(starts) == 1
            above = np.zeros(1, np.uint64) if top else shared
            self.levels.append((pattern, mask & ~above[np.zeros(len(pattern), int) if top else np.arange(len(pattern)) // FAN]))
            if top:
                break
            pattern, mask = pattern[starts] & shared, shared
        self.levels.reverse()

    def near(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, code) by position, at most `radius` bits apart."""
        q = np.repeat(np.arange(len(queries)), len(self.levels[0][0]))
        node = np.tile(np.arange(len(self.levels[0][0])), len(queries))
        apart = np.zeros(len(q), np.int64)
        for depth, (pattern, mask) in enumerate(self.levels):
            if depth:
                q, apart = np.repeat(q, FAN), np.repeat(apart, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                real = node < len(pattern)
                q, node, apart = q[real], node[real], apart[real]
            apart = apart + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            close = apart <= radius
            q, node, apart = q[close], node[close], apart[close]
        return q, node


def forest(codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, smallest code reachable by links within the bucket), for codes that are not the smallest themselves."""
    index = GrayIndex(codes)
    codes = index.codes
    a, b = [], []
    for at in range(0, len(codes), QUERIES):
        q, node = index.near(codes[at:at + QUERIES], radius)
        linked = q + at < node
        a.append(q[linked] + at)
        b.append(node[linked])
    a, b = np.concatenate(a), np.concatenate(b)
    root = codes.copy()
    while len(a):
        low = np.minimum(root[a], root[b])
        if (root[a] == low).all() and (root[b] == low).all():
            break
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
    moved = root != codes
    return codes[moved], root[moved]


def _forests(radius: int):
    """Over rows sorted by bucket: the forest of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("simhash")
        held_key, held = None, []
        for batch in batches:
            keys = batch.column("_key").to_numpy(zero_copy_only=False)
            codes = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            out = []
            for part_key, part in zip(keys[np.append([0], cuts)] if len(keys) else [], np.split(codes, cuts)):
                if part_key != held_key and held:
                    out.append(forest(np.concatenate(held), radius))
                    held = []
                held_key = part_key
                held.append(part)
            yield _edges(out)
        yield _edges([forest(np.concatenate(held), radius)] if held else [])

    return run


def _edges(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u, v = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.uint64) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])


# ---- dealing out


def blocks(bits: list[int], pieces: int) -> list[list[int]]:
    """The bits cut in runs of nearly equal length."""
    edges = [round(len(bits) * k / pieces) for k in range(pieces + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:])]


def _signed(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def near_edges(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (u, v) that connect what links of at most `radius` bits connect, over distinct longs `fp`."""
    parts = prints.sparkSession.conf.get("spark.sql.shuffle.partitions")
    rows = prints.select("fp", F.lit(0).alias("_path"), F.lit(0).cast("long").alias("_key"))
    rests = [list(range(BITS))]
    found = None
    while True:
        cut = [blocks(rest, radius + 1) for rest in rests]
        masks = F.array(*[F.array(*[F.lit(_signed(b)).cast("long") for b in c]) for c in cut])
        dealt = rows.select("fp", "_path", "_key", F.posexplode(F.element_at(masks, F.col("_path") + 1)).alias("_k", "_mask")) \
            .select("fp", (F.col("_path") * (radius + 1) + F.col("_k")).alias("_path"),
                    F.xxhash64("_key", "_path", "_k", F.col("fp").bitwiseAND(F.col("_mask"))).alias("_key"))
        sizes = dealt.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1")
        sized = durable(dealt.join(sizes, "_key"))
        ready = sized.where(F.col("_n") <= BUCKET)
        edges = ready.select("_key", "fp").repartition(int(parts), "_key").sortWithinPartitions("_key") \
            .mapInArrow(_forests(radius), "u long, v long")
        found = edges if found is None else found.unionAll(edges)
        rests = [sorted(set(rest) - set(b)) for rest, c in zip(rests, cut) for b in c]
        rows = sized.where(F.col("_n") > BUCKET).select("fp", "_path", "_key")
        # Buckets with so few bits left are bounded by the number of their values.
        if min(map(len, rests)) <= radius + 1 or rows.isEmpty():
            last = rows.select("_key", "fp").repartition(int(parts), "_key").sortWithinPartitions("_key")
            return found.unionAll(last.mapInArrow(_forests(radius), "u long, v long")).distinct()


def connect(edges: DataFrame) -> DataFrame:
    """(node, root): every node of an edge list with the smallest node of its component, roots included.

    Alternates the large-star and small-star steps; each round is written to the shared folder, and the work of a node
    with many neighbours is an aggregation with partial sums and a join that Spark can split.
    """
    now = durable(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")) \
            .select("e.*").where("u <> v").distinct()
        now = durable(small)
        got = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38)"))).first()
        if got == state:
            break
        state = got
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def groups(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """Per row: doc_id, fp, component_id, the smallest doc_id reachable over links of at most `radius` bits.

    Copies share a fingerprint and are one node of the graph. A null doc_id takes part, but is never the smallest unless
    its group has no other: then component_id is null. Repeated rows give repeated results, an empty table none.
    """
    prints = durable(docs.select("doc_id", fingerprints("text", words).alias("fp")))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connect(near_edges(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    linked = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    component = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(linked.join(component, "root").select("fp", "component_id"), "fp")


def components(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, its fingerprint in hexadecimal and component_id; see `groups`."""
    return groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """The rows of `docs`, whatever their columns, but for all save one of each group of linked fingerprints.

    Groups are those of `groups`. The row with the smallest doc_id stays (null last, then by the text's hash); of rows equal
    in doc_id and text, one. Null and empty texts and those without words are one group. An empty table stays empty.
    """
    tie, key, other = fresh(docs.columns, "_tie", "_key", "_other")
    hashed = F.xxhash64(text_or_empty())
    prints = durable(docs.select("doc_id", hashed.alias("tie"), fingerprints("text", words).alias("fp")))
    roots = connect(near_edges(prints.select("fp").distinct(), radius)).withColumnRenamed("node", "fp")
    rooted = prints.join(maybe_broadcast(durable(roots), F.lit(16)), "fp", "left") \
        .select("doc_id", "tie", F.coalesce("root", "fp").alias("root"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    least = rooted.groupBy("root").agg(F.min(place).alias("least"), F.count("*").alias("n")).where("n > 1").select("root", "least")
    met = rooted.join(maybe_broadcast(durable(least), F.lit(48)), "root")
    stays = place.eqNullSafe(F.col("least"))
    gone = durable(met.where(~stays).select("doc_id", "tie").distinct())
    repeated = durable(met.where(stays).groupBy("doc_id", "tie").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "tie"))
    keyed = docs.withColumn(tie, hashed)
    on = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(tie) == F.col(other))
    left = keyed.join(maybe_broadcast(gone.toDF(key, other), F.lit(32)), on, "left_anti")
    several = maybe_broadcast(repeated.toDF(key, other), F.lit(32))
    once = left.join(several, on, "left_anti")
    single = left.join(several, on, "left_semi").dropDuplicates(["doc_id", tie])
    return once.unionByName(single).select(*docs.columns)
