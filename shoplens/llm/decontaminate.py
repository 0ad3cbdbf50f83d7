"""Benchmark decontamination: find the words of documents that lie in a window of a benchmark item.

Built-in functions only. A window must occur whole, so of its three-word shingles, ordered by rarity, the rarest alone is
a sufficient prefix. The documents' occurrences of any shingle of the items are gathered and counted; each distinct window
is known by its rarest shingle and that shingle's place, and only occurrences of these become candidates. A candidate's
start follows from the two places and must leave room for the window (positional and length bound); then the words
themselves are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import LOWER, UPPER, fresh, text_or_empty
from shoplens.session import durable, fits_broadcast

WINDOW, SHINGLE = 10, 3
# Everything below U+0080 but digits and letters; capitals are gone by then.
BETWEEN = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
BETWEEN_PATTERN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str | Column = "text") -> Column:
    """Words of a text, A-Z in lower case; null has none. `lower` is used where it changes nothing but A-Z."""
    whole = text_or_empty(text)
    lowered = F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))
    trimmed = F.btrim(lowered, F.lit(BETWEEN))
    return F.when(trimmed != "", F.split(trimmed, BETWEEN_PATTERN)).otherwise(F.array().cast("array<string>"))


def maybe_broadcast(df: DataFrame, row_bytes: Column) -> DataFrame:
    """`df` with a broadcast hint if it is measured to be small; else Spark shuffles."""
    return F.broadcast(df) if fits_broadcast(df, row_bytes) else df


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, win): the distinct windows of each item, words joined by blanks; those of items without id have a null item."""
    n = F.size("_w")
    starts = F.when(n >= window, F.sequence(F.lit(1), n - window + 1)).otherwise(F.array(F.lit(1)))
    return items.select(F.col("item_id").cast("string").alias("item"), words().alias("_w")) \
        .where(n > 0).select("item", "_w", F.explode(starts).alias("_s")) \
        .select("item", F.array_join(F.slice("_w", F.col("_s"), window), " ").alias("win")).distinct()


def shingle_hash(size: int) -> Column:
    """Hash of the shingle of `size` words that begins with the words a, b, c; null where there are too few."""
    parts = [F.col(c) for c in "abc"[:size]]
    return F.when(parts[-1].isNotNull(), F.xxhash64(F.lit(size), *parts))


def _spread(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """A row for each word of an array: `keep`, its place `at` from 0, and with it the two words that follow."""
    n = F.greatest(F.size(column), F.lit(1))
    following = [F.slice(column, k, n).alias(c) for k, c in ((2, "b"), (3, "c"))]
    return df.select(*keep, F.col(column).alias("a"), *following).select(*keep, F.posexplode(F.arrays_zip("a", "b", "c")).alias("at", "s")) \
        .select(*keep, "at", "s.a", "s.b", "s.c")


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(k1, k2, n_hit, item_ids, spans) for each distinct text of `docs` with a hit; k1, k2 are the hashes of the text.

    `spans` lists the [start, end) word positions of the occurrences. Texts with equal pairs of 64-bit hashes count as
    copies and are reported once.
    """
    texts = docs.select(text_or_empty().alias("text")).select(*text_key("text"), "text")
    windows = durable(item_windows(items, window))
    distinct = windows.select("win").distinct().withColumn("w", F.split("win", " ")).withColumn("size", F.size("w"))
    # A window shorter than a shingle is one shingle; windows have few sizes, shingles at most three.
    parted = _spread(distinct, "w", "win", "size").withColumn("shingle", F.coalesce(*[
        F.when(F.least("size", F.lit(SHINGLE)) == k, shingle_hash(k)) for k in range(1, SHINGLE + 1)])).where("shingle is not null")
    parted = durable(parted.select("win", "size", F.col("at").alias("place"), "shingle"))
    sizes = sorted(r[0] for r in parted.select(F.least("size", F.lit(SHINGLE))).distinct().collect())
    known = maybe_broadcast(parted.select("shingle").distinct(), F.lit(16))
    spoken = _spread(texts.select("k1", "k2", words("text").alias("w")), "w", "k1", "k2") \
        .select("k1", "k2", "at", F.explode(F.array(*[shingle_hash(k) for k in sizes or [SHINGLE]])).alias("shingle"))
    met = durable(spoken.join(known, "shingle").distinct())
    counts = met.groupBy("shingle").agg(F.count("*").alias("n"))
    # Windows with a shingle that no document has are left out.
    rare = parted.join(counts, "shingle", "left").groupBy("win", "size").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "place")).alias("rarest")) \
        .where("rarest.n > 0").select("rarest.shingle", "rarest.place", "size", "win")
    rare = maybe_broadcast(durable(rare), F.octet_length("win") + 48)
    candidates = met.join(rare, "shingle").select("k1", "k2", (F.col("at") - F.col("place")).alias("start"), "size", "win") \
        .where("start >= 0").groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "size", "win")).alias("c"))
    candidates = durable(candidates)
    row_bytes = F.aggregate("c", F.lit(64).cast("long"), lambda a, x: a + F.octet_length(x["win"]) + 48)
    same = lambda x: F.array_join(F.slice("w", x["start"] + 1, x["size"]), " ") == x["win"]
    held = texts.join(maybe_broadcast(candidates, row_bytes), ["k1", "k2"]).dropDuplicates(["k1", "k2"]) \
        .select("k1", "k2", "c", words("text").alias("w")).select("k1", "k2", "w", F.filter("c", lambda x: x["start"] + x["size"] <= F.size("w")).alias("c")) \
        .select("k1", "k2", F.filter("c", same).alias("c")).where(F.size("c") > 0)
    place = F.transform("c", lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["size"]).alias("end")))
    covered = F.flatten(F.transform("c", lambda x: F.sequence(x["start"], x["start"] + x["size"] - 1)))
    held = durable(held.select("k1", "k2", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
                               F.array_sort(F.array_distinct(place)).alias("spans"), F.transform("c", lambda x: x["win"]).alias("wins")))
    # An item without id has no place in the list.
    named = held.select("k1", "k2", F.explode("wins").alias("win")).distinct().join(windows, "win") \
        .select("k1", "k2", "item").distinct().groupBy("k1", "k2").agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    return durable(held.join(named, ["k1", "k2"]).select("k1", "k2", "n_hit", "item_ids", "spans"))


def text_key(text: str | Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a text, that together stand for it."""
    column = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(column).alias("k1"), F.xxhash64(F.lit(1), column).alias("k2")


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Windows of items without id make hits too, but such items are not counted or listed. A null text has no words and no hits,
    a null doc_id stays null, repeated rows give repeated results; empty tables give no rows (documents) or no hits (items).
    Other columns are not looked at.
    """
    found = hits(docs, items, window).select("k1", "k2", "n_hit", "item_ids")
    rows = docs.select("doc_id", text_or_empty().alias("text")).select("doc_id", *text_key("text"), F.size(words("text")).cast("long").alias("n_words"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return rows.join(found, ["k1", "k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs`, whatever their columns, whose texts hold no window of an item, be its id null or not."""
    found = hits(docs, items, window).select("k1", "k2")
    a, b = fresh(docs.columns, "_k1", "_k2")
    found = maybe_broadcast(found.toDF(a, b), F.lit(32))
    k1, k2 = text_key(text_or_empty())
    return docs.withColumns({a: k1, b: k2}).join(found, [a, b], "left_anti").select(*[docs[c] for c in docs.columns])
