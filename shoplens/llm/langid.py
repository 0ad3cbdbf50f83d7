"""Language identification by fusing what the text, the declaration, the address suffix and the host say.

The likelihood of a text is that of its hashed letter trigrams under a multinomial of each language, learned from all
rows that declare it, and toned down for long texts, whose trigrams do not vote independently. What the rows' texts say
alone is then counted by declaration, suffix and host in grouped aggregations. They give the chance of a declaration
under each language, and priors smoothed from the whole corpus to the suffix and from the suffix to the host. Bayes'
rule joins the three. A class of noise, uniform over the trigrams, stands for what is in no language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import fresh, text_or_empty, worker_state
from shoplens.llm.decontaminate import maybe_broadcast
from shoplens.session import durable

BUCKETS, SMOOTHING = 1 << 15, 0.5
# A declared value gets a model if its rows have so many trigrams, whatever the size of the table: with fewer, the smoothed
# model is too near to noise. Languages scored in one pass: bounds the table that a worker holds, not their number.
LEAST_TRIGRAMS, SLAB = 4000, 128
# Trigrams whose votes count in full; weights of the smoothing from corpus to suffix to host, and of declarations.
FULL_VOTES, SUFFIX_WEIGHT, HOST_WEIGHT, DECLARED_WEIGHT = 100, 20.0, 20.0, 5.0
# Columns that the work adds to those kept.
OWN = {"text", "declared", "host", "suffix", "ll", "spoken", "vote", "prior", "chances", "w", "best", "noise"}
# Prior of noise, and the posterior from which a document is accepted.
NOISE, ACCEPTED = 0.001, 0.5


def trigrams(text: str) -> np.ndarray:
    """Buckets of the trigrams of letters and blanks; whatever is no letter counts as one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    letter = ((points > 96) & (points < 123)) | ((points > 191) & (points != 215) & (points != 247))
    points = np.where(letter, points, 32)
    points = points[np.append(True, letter[1:] | letter[:-1])] if len(points) else points
    if not (letter.any() and len(points) > 2):
        return np.zeros(0, np.int64)
    points = points.astype(np.uint64)
    mixed = (points[:-2] * np.uint64(0x9E3779B1) + points[1:-1]) * np.uint64(0x85EBCA6B) + points[2:]
    mixed ^= mixed >> np.uint64(21)
    return ((mixed * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - 15)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(declared, bucket, n), in parts: the counts of at most SLAB declarations are held at a time."""
    worker_state("langid")
    counts: dict[str, np.ndarray] = {}

    def parts() -> Iterator[pa.RecordBatch]:
        for name, row in counts.items():
            seen = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(seen), pa.string()), pa.array(seen), pa.array(row[seen])],
                                             ["declared", "bucket", "n"])
        counts.clear()

    for batch in batches:
        for text, name in zip(batch.column("text").to_pylist(), batch.column("declared").to_pylist()):
            if name not in counts:
                if len(counts) == SLAB:
                    yield from parts()
                counts[name] = np.zeros(BUCKETS, np.int64)
            counts[name] += np.bincount(trigrams(text), minlength=BUCKETS)
    yield from parts()


def learn(rows: DataFrame) -> tuple[list[str], Iterator[np.ndarray]]:
    """The languages, and log probabilities (bucket, language) of SLAB of them after the other; `rows`: text, declared."""
    counted = durable(rows.where("declared is not null").select("text", "declared")
                      .mapInArrow(_count, "declared string, bucket long, n long").groupBy("declared", "bucket").agg(F.sum("n").alias("n")))
    enough = counted.groupBy("declared").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TRIGRAMS)
    languages = sorted(r["declared"] for r in enough.select("declared").collect())

    def slabs() -> Iterator[np.ndarray]:
        for at in range(0, len(languages), SLAB):
            place = {name: k for k, name in enumerate(languages[at:at + SLAB])}
            table = np.full((len(place), BUCKETS), SMOOTHING)
            for name, bucket, n in counted.where(F.col("declared").isin(list(place))).toLocalIterator():
                table[place[name], bucket] += n
            table /= table.sum(axis=1, keepdims=True)
            yield np.log(table).T.copy()

    return languages, slabs()


def likelihoods(df: DataFrame, table: np.ndarray) -> Column:
    """Toned-down log likelihoods of a text column under each column of `table`; all zero for a text without letters."""
    shared = df.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_state("langid")
        for texts in batches:
            out = []
            for text in texts.to_pylist():
                found = trigrams(text)
                total = sum((shared.value[found[a:a + 65536]].sum(axis=0) for a in range(0, len(found), 65536)),
                            np.zeros(shared.value.shape[1]))
                out.append((total * min(1.0, FULL_VOTES / max(1, len(found)))).tolist())
            yield pa.array(out, pa.list_(pa.float64()))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<double>")("text")


def _grouped(counts: DataFrame, *by: str) -> DataFrame:
    """Per group: the counts `n` of its votes as a map, and their sum."""
    return counts.groupBy(*by, "vote").agg(F.sum("n").alias("n")).groupBy(*by) \
        .agg(F.map_from_entries(F.collect_list(F.struct("vote", "n"))).alias("shares"), F.sum("n").alias("total"))


def _smoothed(above: Column, weight: float) -> Column:
    """Shares of the languages in a group, smoothed towards those `above` it."""
    own = lambda k: F.coalesce(F.try_element_at("shares", k.cast("long")), F.lit(0))
    return F.transform(above, lambda a, k: (own(k) + weight * a) / (F.col("total") + weight))


def identify(df: DataFrame, declared: Column, host: Column, suffix: Column, keep: list[str]) -> DataFrame:
    """Per row of `df` (text and others): the columns `keep`, text_language, language, confidence, accepted.

    Null text, host, suffix and declaration count as empty; an empty declaration says nothing. A text without letters
    has no language of its own: `language` is null and it is not accepted. Where the declaration has too little text for a
    model, what no model explains is in the declared language instead of noise. Repeated rows give repeated results, an empty
    table none. Ties go to the language first in the alphabet.
    """
    if {c.lower() for c in keep} & OWN:
        raise ValueError(f"kept columns must have other names than {sorted(OWN)}")
    empty = F.lit("")
    rows = df.select(*keep, text_or_empty().alias("text"), F.nullif(F.lower(declared), empty).alias("declared"),
                     F.coalesce(host, empty).alias("host"), F.coalesce(suffix, empty).alias("suffix"))
    languages, slabs = learn(rows.select("text", "declared"))
    size = len(languages)
    noise = np.full((BUCKETS, 1), -np.log(BUCKETS))
    if not size:
        told = F.exists(likelihoods(rows, noise), lambda x: x != 0) & F.col("declared").isNotNull()
        return rows.withColumn("accepted", told).select(
            *keep, F.lit(None).cast("string").alias("text_language"), F.when(F.col("accepted"), F.col("declared")).alias("language"),
            F.col("accepted").cast("double").alias("confidence"), "accepted")
    scored = rows
    for k, table in enumerate(slabs):
        last = (k + 1) * SLAB >= size
        found = likelihoods(rows, np.hstack([table, noise]) if last else table)
        scored = scored.withColumn("ll", F.concat("ll", found) if k else found)
        scored = scored if last else durable(scored)
    scored = scored.withColumn("spoken", F.exists("ll", lambda x: x != 0)) \
        .withColumn("vote", F.array_position(F.slice("ll", 1, size), F.array_max(F.slice("ll", 1, size))) - 1).drop("text")
    scored = durable(scored)
    votes = scored.where("spoken")
    names = F.array(*map(F.lit, languages))
    # The corpus is one group; suffixes and hosts stay tables.
    counts = durable(votes.groupBy("host", "suffix", "vote").agg(F.count("*").alias("n")))
    totals = {r["vote"]: r["n"] for r in counts.groupBy("vote").agg(F.sum("n").alias("n")).collect()}
    whole = F.array(*[F.lit((totals.get(k, 0) + 1.0) / (sum(totals.values()) + size)) for k in range(size)])
    suffixes = _grouped(counts, "suffix").select("suffix", _smoothed(whole, SUFFIX_WEIGHT).alias("above"))
    hosts = _grouped(counts, "host", "suffix").join(suffixes, "suffix") \
        .select("host", "suffix", _smoothed(F.col("above"), HOST_WEIGHT).alias("prior"))
    # Chance of a declaration under each language: its rows among the language's rows that declare anything.
    said = votes.where("declared is not null").groupBy("declared", "vote").agg(F.count("*").cast("double").alias("n"))
    by_vote = said.groupBy("vote").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
    chance = said.join(by_vote, "vote").select("declared", "vote", F.struct(
        F.col("vote").alias("k"), ((F.col("n") + DECLARED_WEIGHT) / (F.col("all") + DECLARED_WEIGHT * (F.col("kinds") + 1))).alias("c")).alias("e"))
    chance = chance.groupBy("declared").agg(F.collect_list("e").alias("chances"))
    rare = {r["vote"]: DECLARED_WEIGHT / (r["all"] + DECLARED_WEIGHT * (r["kinds"] + 1)) for r in by_vote.collect()}
    unseen = F.array(*[F.lit(float(rare.get(k, 1.0))) for k in range(size)])
    joined = scored.join(hosts, ["host", "suffix"], "left").join(chance, "declared", "left")
    prior = F.coalesce("prior", whole)

    def told(k: Column) -> Column:
        own = F.filter("chances", lambda e: e["k"] == k)
        found = F.when(F.size(own) > 0, F.get(own, F.lit(0))["c"]).otherwise(F.get(unseen, k))
        return F.when(F.col("declared").isNull(), F.lit(0.0)).otherwise(F.log(found))

    weights = F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                          lambda k: F.get("ll", k) + F.log(F.get("prior", k) * (1 - NOISE)) + told(k))
    fused = joined.withColumn("prior", prior).withColumn("w", weights) \
        .withColumn("noise", F.get("ll", F.lit(size)) + F.log(F.lit(NOISE))) \
        .withColumn("best", F.array_max("w"))
    top = F.greatest("best", "noise")
    mass = F.aggregate("w", F.exp(F.col("noise") - top), lambda a, x: a + F.exp(x - top))
    spoken = F.col("spoken")
    own, noise_share = F.exp(F.col("best") - top) / mass, F.exp(F.col("noise") - top) / mass
    unmodelled = F.col("declared").isNotNull() & ~F.coalesce(F.array_contains(names, F.col("declared")), F.lit(False))
    declared_wins = unmodelled & (F.col("noise") > F.col("best"))
    best = F.get(names, (F.array_position("w", F.col("best")) - 1).cast("int"))
    return fused.select(
        *keep, F.when(spoken, F.get(names, F.col("vote").cast("int"))).alias("text_language"),
        F.when(spoken, F.when(declared_wins, F.col("declared")).otherwise(best)).alias("language"),
        F.when(spoken, F.when(declared_wins, noise_share).otherwise(own)).otherwise(0.0).alias("confidence"),
        (spoken & (own + F.when(unmodelled, noise_share).otherwise(0.0) >= ACCEPTED)).alias("accepted"))


def accepted(docs: DataFrame, declared: Column, host: Column, suffix: Column) -> DataFrame:
    """The rows of `docs`, whatever their columns, whose language is recognised."""
    a, b = fresh(docs.columns, "_k1", "_k2")
    said = [text_or_empty(), F.coalesce(F.lower(declared), F.lit("")), F.coalesce(host, F.lit("")), F.coalesce(suffix, F.lit(""))]
    keyed = docs.withColumns({a: F.xxhash64(*said), b: F.xxhash64(F.lit(1), *said)})
    refused = durable(identify(keyed, declared, host, suffix, [a, b]).where("not accepted").select(a, b).distinct())
    return keyed.join(maybe_broadcast(refused, F.lit(32)), [a, b], "left_anti").select(*docs.columns)
