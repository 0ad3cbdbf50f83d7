"""Quality rules: plain text measures, and a hashed n-gram log-likelihood ratio of trusted text against the corpus.

Words and word pairs of the trusted documents and of all documents are counted in hash buckets over the whole corpus;
a task sends one row a bucket. The score of a document is the mean log ratio of the two bucket distributions over its
n-grams. Half of the labelled documents are trusted text; the threshold is found on the other half, which the counts of
trusted text do not know, from a histogram of their scores. Every document is held against it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import text_or_empty
from shoplens.session import durable, fits_broadcast

# Hash buckets (the size of every table sent to the driver or the tasks), additive smoothing, width of a score bin.
BUCKETS, SMOOTHING, BIN = 1 << 15, 1.0, 0.005
# Fixed values of the rules.
SYMBOLS, SPACES = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def word_codes(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, int]:
    """All words of a batch as codes and as 64-bit hashes, and the number of distinct words."""
    encoded = pa.array([w for words in texts for w in words], pa.binary()).dictionary_encode()
    distinct = encoded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct), np.uint64, len(distinct))
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, hashes[codes] if len(codes) else np.zeros(0, np.uint64), len(distinct)


def buckets(h: np.ndarray) -> np.ndarray:
    """Buckets of the words and of the pairs of neighbours."""
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] + np.uint64(0x632BE59BD9B4E019))
    pairs ^= pairs >> np.uint64(29)
    return (np.concatenate([h, pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words that lie in a three-word window found at least twice."""
    if len(codes) < 4:
        return 0
    pairs = codes[:-1] * distinct + codes[1:]
    if distinct >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * distinct + codes[2:]
    _, back, times = np.unique(windows, return_inverse=True, return_counts=True)
    if times.max() < 2:
        return 0
    twice = times[back] > 1
    hit = np.zeros(len(codes), bool)
    for k in range(3):
        hit[k:len(codes) - 2 + k] |= twice
    return int(hit.sum())


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        words = [t.encode().split() for t in batch.column("text").to_pylist()]
        _, h, _ = word_codes(words)
        at = 0
        for trusted, n in zip(batch.column("trusted").to_pylist(), map(len, words)):
            if n:
                found = buckets(h[at:at + n])
                np.add.at(counts[0], found, 1)
                if trusted:
                    np.add.at(counts[1], found, 1)
            at += n
    seen = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[0][seen]), pa.array(counts[1][seen])],
                                     ["bucket", "n_raw", "n_trusted"])


def log_ratios(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """Log ratio of each bucket, from counts over all documents; `trusted` has the doc_id of the trusted ones."""
    ids = trusted.select("doc_id").where("doc_id is not null").distinct().withColumn("trusted", F.lit(True))
    if fits_broadcast(ids, F.lit(16)):
        ids = F.broadcast(ids)
    marked = docs.select("doc_id", text_or_empty().alias("text")).join(ids, "doc_id", "left") \
        .select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counts = marked.mapInArrow(_count, "bucket long, n_raw long, n_trusted long") \
        .groupBy("bucket").agg(F.sum("n_raw"), F.sum("n_trusted")).collect()
    table = np.zeros((2, BUCKETS))
    for bucket, n_raw, n_trusted in counts:
        table[:, bucket] = n_trusted, n_raw
    share = (table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.log(share[0] / share[1])


def measures(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """Per row: doc_id, the plain measures and the mean log ratio (0 for a text without words)."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [t.encode() for t in batch.column("text").to_pylist()]
            words = [t.split() for t in raw]
            codes, h, distinct = word_codes(words)
            at, out = 0, []
            for text, chars, n in zip(raw, batch.column("chars").to_pylist(), map(len, words)):
                mean = float(shared.value[buckets(h[at:at + n])].mean()) if n else 0.0
                out.append((n, chars - len(text) + len(text.translate(None, SPACES)),
                            len(text) - len(text.translate(None, SYMBOLS)), repeated_lines(text),
                            repeated_words(codes[at:at + n], distinct), mean))
                at += n
            if out:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, zip(*out))],
                                                 ["doc_id", *MEASURES, "log_ratio"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{m} long" for m in MEASURES)
    return docs.select("doc_id", text_or_empty().alias("text"), F.char_length(text_or_empty()).alias("chars")) \
        .mapInArrow(run, f"doc_id {kind}, {longs}, log_ratio double")


def threshold(scored: DataFrame, labels: DataFrame) -> float:
    """Edge of a score bin that best parts labelled good from labelled poor documents; the lowest among equals.

    Minus infinity where either kind is missing: nothing is then known against any document.
    """
    bins = scored.where("not base_failed").join(labels.select("doc_id", "quality").where("quality is not null"), "doc_id") \
        .groupBy(F.floor(F.col("log_ratio") / BIN).alias("bin")) \
        .agg(F.sum((F.col("quality") > 0).cast("long")).alias("good"), F.count("*").alias("n")).orderBy("bin").collect()
    good, poor = sum(b["good"] for b in bins), sum(b["n"] - b["good"] for b in bins)
    if not good or not poor:
        return float("-inf")
    best, edge, lost, caught = 0.0, float("-inf"), 0, 0
    for b in bins:
        lost, caught = lost + b["good"], caught + b["n"] - b["good"]
        if caught / poor - lost / good > best:
            best, edge = caught / poor - lost / good, (b["bin"] + 1) * BIN
    return edge


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, the measures, base_failed, kept, log_ratio and threshold.

    A null text has no words and fails the base rules; a null doc_id is judged by the text alone; a document labelled
    more than once is trusted if any label is good. Repeated rows give repeated results, an empty table none.
    """
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    ratios = log_ratios(docs, labels.where("quality > 0").where(half == 0))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    scored = durable(measures(docs, ratios).withColumn("base_failed", base))
    edge = threshold(scored, labels.where(half == 1))
    return scored.withColumn("threshold", F.lit(edge)) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= F.lit(edge))) \
        .select("doc_id", *MEASURES, "base_failed", "kept", "log_ratio", "threshold")
