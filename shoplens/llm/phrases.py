"""Phrase collocations of each language, found by sampling and checked by counting everything (Toivonen's way).

A sample of the documents, counted in full, proposes the phrases that are frequent. One pass over all documents then counts
the proposed phrases and their negative border exactly: every phrase that occurs and whose two parts of one word less are
both proposed. What turns out frequent on the border was missed by the sample; its extensions are counted by further
passes, which count nothing twice, until a pass finds no new phrase that could be extended.

The set of proposed phrases is known to the tasks as a table of bits of fixed size, addressed by a hash of language and
words. A bit that stands for another phrase costs some counting and changes no result: counts are kept by the words
themselves, and what is rare is dropped after counting. A fuller table only prunes less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import UPPER, LOWER, text_or_empty
from shoplens.llm.decontaminate import maybe_broadcast
from shoplens.operators.topk import top_per_group
from shoplens.session import durable

LONGEST, MIN_COUNT, INSIDE, TOP = 4, 30, 80, 2000
# One document in so many is sampled.
SAMPLE_ONE_IN = 32
# Bits of the table of proposed phrases, as a power of two: 8 MB whatever the corpus.
LOG_BITS = 26
# Text tokenised at once; distinct words known to a task before it starts afresh.
SLAB_BYTES, WORDS = 3 << 20, 400_000
BREAK, BREAKS = b".", b".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans(BREAKS + UPPER.encode(), BREAK * len(BREAKS) + LOWER.encode())
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
# Buckets of phrases for each shuffle partition; rows of a bucket that are held before they are summed.
BUCKETS, HELD = 1, 1 << 21
BLOCKS = "bucket long, block binary"
# size 0: the number of words of the language.
COUNTS = "lang string, size int, phrase string, key long, n long"


# ---- counting in a task


class Words(dict):
    """Numbers of the words of one language, given when first asked for; number 0 is the break between pieces."""

    def __init__(self):
        super().__init__({BREAK: 0})
        self.names, self.hashes = [BREAK], np.zeros(1024, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        if number == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros(number, np.uint64)])
        self.hashes[number] = xxhash.xxh64_intdigest(word)
        return number


def slabs(texts: list[str]) -> Iterator[bytes]:
    """The texts, folded, with a break between each two, in parts of bounded size that are cut at breaks."""
    held, size = [], 0
    for text in texts:
        folded = text.encode().translate(FOLD)
        while len(folded) > SLAB_BYTES and (cut := folded.find(BREAK, SLAB_BYTES)) >= 0:
            yield folded[:cut]
            folded = folded[cut:]
        held.append(folded)
        size += len(folded)
        if size >= SLAB_BYTES:
            yield BREAK.join(held)
            held, size = [], 0
    if held:
        yield BREAK.join(held)


def bit_address(key: np.ndarray) -> np.ndarray:
    return key >> np.uint64(64 - LOG_BITS)


def marked(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = bit_address(key)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def phrase_keys(hashes: np.ndarray, lang: int) -> list[np.ndarray]:
    """For each size, the 64-bit keys of the phrases that begin at each place."""
    state, out = hashes, []
    for size in range(1, min(LONGEST, len(hashes)) + 1):
        if size > 1:
            state = state[:-1] * STEP + hashes[size - 1:]
        key = (state ^ np.uint64(lang)) * MIX
        out.append((key ^ (key >> np.uint64(29))) * STEP)
    return out


def count_slab(ids: np.ndarray, words: Words, lang: int, proposed: np.ndarray | None, counted: np.ndarray | None) -> Iterator[tuple]:
    """(size, columns of word numbers, keys, counts) of the phrases to count in a row of word numbers.

    Without `proposed` all phrases are counted; else those with both parts proposed, but for those with both parts in
    `counted`, which an earlier pass has counted. Single words and their sum are counted where `counted` is None.
    """
    keys = phrase_keys(words.hashes[ids], lang)
    inside = ids > 0
    if counted is None:
        totals = np.bincount(ids, minlength=1)
        totals[0] = 0
        found = np.flatnonzero(totals)
        if len(found):
            yield 0, [], np.zeros(1, np.uint64), totals.sum(keepdims=True)
            yield 1, [found], phrase_keys(words.hashes[found], lang)[0], totals[found]
    for size in range(2, LONGEST + 1):
        n = len(ids) - size + 1
        if n <= 0:
            return
        inside = inside[:n] & (ids[size - 1:] > 0)
        wanted = inside
        if proposed is not None:
            at = np.flatnonzero(inside)
            part = keys[size - 2]
            good = marked(proposed, part[at]) & marked(proposed, part[at + 1])
            if counted is not None:
                good &= ~(marked(counted, part[at]) & marked(counted, part[at + 1]))
            at = at[good]
        else:
            at = np.flatnonzero(wanted)
        if not len(at):
            continue
        # Equal phrases get equal codes, word by word, so that no hash decides what is equal.
        code = ids[at]
        for k in range(1, size):
            if k > 1:
                _, code = np.unique(code, return_inverse=True)
            code = code.astype(np.int64) << 32 | ids[at + k]
        _, first, times = np.unique(code, return_index=True, return_counts=True)
        at = at[first]
        yield size, [ids[at + k] for k in range(size)], keys[size - 1][at], times


def packed(times: np.ndarray, phrases: pa.Array) -> tuple[bytes, ...]:
    """Counts, lengths and letters of phrases that stand in one row of bytes each."""
    ends = np.frombuffer(phrases.buffers()[1], np.int32)[phrases.offset:phrases.offset + len(phrases) + 1]
    letters = memoryview(phrases.buffers()[2] or b"")[ends[0]:ends[-1]]
    return np.uint32(len(times)).tobytes(), times.astype("<u4").tobytes(), np.diff(ends).astype("<u4").tobytes(), letters


def unpacked(block: bytes) -> pa.Table:
    n = int(np.frombuffer(block, "<u4", 1)[0])
    times = np.frombuffer(block, "<u4", n, 4).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(block, "<u4", n, 4 + 4 * n))]).astype(np.int64)
    phrases = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(block[4 + 8 * n:])])
    return pa.table({"phrase": phrases, "n": times})


def counting(proposed, counted, buckets: int):
    """Over rows of (lang, text): rows of BLOCKS, one for each batch and bucket, with each phrase once for each slab that holds it.

    Most phrases of the border are rare, so they are many: they travel as compressed blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, old = (None if b is None else b.value for b in (proposed, counted))
        compress = zstandard.ZstdCompressor(level=1).compress
        known: dict[str, Words] = {}

        def blocks(lang: str, words: Words, slab: bytes, held: dict[int, list[bytes]]) -> None:
            tokens = slab.replace(BREAK, b" . ").split()
            ids = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
            names = pa.array(words.names, pa.binary())
            name = lang.encode()
            for size, columns, keys, times in count_slab(ids, words, xxhash.xxh64_intdigest(lang), bits, old):
                bucket = (keys % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                spoken = [names.take(pa.array(c[order])) for c in columns]
                phrase = pc.binary_join_element_wise(*spoken, b" ") if len(spoken) > 1 else spoken[0] if spoken else pa.array([b""], pa.binary())
                used, first = np.unique(bucket[order], return_index=True)
                ends, times = [*first[1:].tolist(), len(times)], times[order]
                for which, i, j in zip(used.tolist(), first.tolist(), ends):
                    body = compress(b"".join(packed(times[i:j], phrase.slice(i, j - i))))
                    held.setdefault(which, []).append(b"".join([np.array([len(name), size, len(body)], "<u4").tobytes(), name, body]))

        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            held: dict[int, list[bytes]] = {}
            for lang in dict.fromkeys(langs):
                for slab in slabs([t for t, x in zip(texts, langs) if x == lang]):
                    blocks(lang, known.setdefault(lang, Words()), slab, held)
                    if sum(map(len, known.values())) > WORDS:
                        known = {}
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(map(b"".join, held.values())), pa.binary())], ["bucket", "block"])

    return run


def parts_of(block: bytes, expand) -> Iterator[tuple[str, int, pa.Table]]:
    """(lang, size, counts) of the parts of a block."""
    at = 0
    while at < len(block):
        name, size, body = np.frombuffer(block, "<u4", 3, at).tolist()
        at += 12
        yield block[at:at + name].decode(), size, unpacked(expand(block[at + name:at + name + body]))
        at += name + body


def summing(min_count: int):
    """Over rows of BLOCKS sorted by bucket: rows of COUNTS, each phrase once, if it occurs `min_count` times."""

    def summed(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by("phrase").aggregate([("n", "sum")]).rename_columns(["phrase", "n"])

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, size), tables in held.items():
            whole = summed(tables)
            if size:
                whole = whole.filter(pc.greater_equal(whole.column("n"), min_count))
            spoken = whole.column("phrase").to_pylist()
            if not spoken:
                continue
            words = np.array([[xxhash.xxh64_intdigest(w) for w in p.split(b" ")] for p in spoken], np.uint64)
            seed = xxhash.xxh64_intdigest(lang)
            keys = phrase_keys(words.T, seed)[-1][0] if size else np.zeros(len(spoken), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(spoken), pa.string()), pa.array(np.full(len(spoken), size, np.int32)),
                 pa.array(spoken, pa.binary()).cast(pa.string()), pa.array(keys.view(np.int64)), pa.array(whole.column("n").to_numpy())],
                ["lang", "size", "phrase", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        held, size, limit, key = {}, 0, HELD, None
        for batch in batches:
            for bucket, block in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != key:
                    yield from rows(held)
                    held, size, limit, key = {}, 0, HELD, bucket
                for lang, words, table in parts_of(block, expand):
                    held.setdefault((lang, words), []).append(table)
                    size += len(table)
                if size > limit:
                    held = {k: [summed(t)] for k, t in held.items()}
                    size = sum(len(t) for t, in held.values())
                    limit = max(HELD, 2 * size)
        yield from rows(held)

    return run


# ---- jobs


def _counts(texts: DataFrame, min_count: int, proposed=None, counted=None) -> DataFrame:
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = texts.mapInArrow(counting(proposed, counted, BUCKETS * parts), BLOCKS)
    return blocks.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(summing(min_count), COUNTS)


def bits_of(found: DataFrame) -> np.ndarray:
    """The table in which the phrases of `found` that can be extended are marked; what is collected is bounded by its size."""
    at = F.shiftrightunsigned("key", 64 - LOG_BITS)
    rows = found.where(F.col("size").between(1, LONGEST - 1)).select(F.shiftright(at, 6).alias("word"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit")) \
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    bits = np.zeros(1 << (LOG_BITS - 6), np.uint64)
    bits[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return bits


def frequent(docs: DataFrame, min_count: int = MIN_COUNT, one_in: int = SAMPLE_ONE_IN) -> DataFrame:
    """(lang, size, phrase, key, n): all phrases of up to LONGEST words with n >= min_count, and the words of a language as size 0.

    A null lang is `und`, a null text empty. Repeated rows count each time. The result doesn't depend on the sample.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text"), F.xxhash64("doc_id", "text").alias("draw"))
    sample = texts.where(F.pmod("draw", F.lit(one_in)) == 0).select("lang", "text")
    texts = texts.select("lang", "text")
    proposed = bits_of(_counts(sample, max(2, min_count // (2 * one_in))))
    counted, found = None, None
    while True:
        shared = [None if b is None else spark.sparkContext.broadcast(b) for b in (proposed, counted)]
        new = durable(_counts(texts, min_count, *shared))
        for b in shared:
            if b is not None:
                b.unpersist()
        found = new if found is None else found.unionAll(new)
        grown = proposed | bits_of(new)
        if (grown == proposed).all():
            return found
        proposed, counted = grown, proposed


def _beginning(words: int | Column) -> Column:
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), words)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, inside: int = INSIDE, top: int = TOP, one_in: int = SAMPLE_ONE_IN) -> DataFrame:
    """The `top` phrases of each language (lang, rank, phrase, a, l, r, n, score), those of the highest score first.

    A phrase of 2 to 4 words is split where its score is lowest. A phrase goes if it lies within a longer one that has at
    least `inside` per cent of its occurrences. Ties go to the more frequent, then to the smaller in byte order. Documents
    without words and empty tables give no rows; columns but doc_id, lang and text are not looked at.
    """
    found = frequent(docs, min_count, one_in)
    words = found.where("size = 0").select("lang", F.col("n").alias("words"))
    phrases = found.where("size > 0").select("lang", "size", "phrase", "n")
    known = maybe_broadcast(phrases.select("lang", "phrase", "n"), F.octet_length("phrase") + 48)
    cuts = phrases.where("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))) \
        .select("lang", "phrase", "size", F.col("n").alias("a"), "k", _beginning(F.col("k")).alias("one"), _beginning(F.col("k") - F.col("size")).alias("rest"))
    cuts = cuts.join(known.toDF("lang", "one", "l"), ["lang", "one"]).join(known.toDF("lang", "rest", "r"), ["lang", "rest"])
    score = F.expr("(cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Each longer phrase names the shorter ones within it.
    spans = F.array(*[F.struct(F.lit(size).alias("of"), F.lit(start).alias("start"), F.lit(length).alias("length"))
                      for size in range(3, LONGEST + 1) for length in range(2, size) for start in range(size - length + 1)])
    held = phrases.where("size > 2").select("lang", "size", "phrase", "n", F.explode(spans).alias("s")).where("s.of = size") \
        .select("lang", F.array_join(F.slice(F.split("phrase", " "), F.col("s.start") + 1, F.col("s.length")), " ").alias("phrase"), "n") \
        .groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    hundred = lambda c, k: F.col(c).cast("decimal(19, 0)") * F.lit(k).cast("decimal(7, 0)")
    alone = lowest.join(held, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (hundred("longer", 100) < hundred("a", inside)))
    rows = alone.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ranked = top_per_group(rows, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, spread_by="phrase")
    return ranked.join(F.broadcast(words) if words.count() < 10_000 else words, "lang") \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
