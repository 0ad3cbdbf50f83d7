"""Token ids as binary shards with keyed access.

A store is a folder of Parquet files whose rows are shards of consecutive documents in ascending order of their keys:
`payload` holds the raw little-endian ids (16 bits where the vocabulary allows it, else 32), `bounds` the offset of each
document, and a minimal perfect hash leads from a key to its document: `displacement` and `seed`, and for each slot the
document's number and a fingerprint of its key. A lookup is one hash, one comparison of fingerprints and one slice.
Spark's writer commits the files, so a lost executor leaves no half shard, and any file system that Spark reaches will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shoplens.llm.common import text_or_empty, worker_state
from shoplens.llm.perfect_hash import PerfectHash, hash_keys

# Ids of a shard, unless one document alone has more; bytes of the words that a worker remembers, and what an entry takes
# besides characters and ids; characters beyond which a word is not remembered; words encoded at once.
SHARD_IDS, WORDS, ENTRY, REMEMBERED, AT_ONCE = 1 << 20, 120 << 20, 220, 64, 4096
LINE, LINE_WORD = "\n", " \n\n"
# Entries of the table that routes keys to shards.
ROUTES = 1 << 16
SHARD = ("part long, shard long, docs long, ids long, width int, seed int, least long, most long, keys binary, "
         "known binary, bounds binary, displacement binary, numbers binary, fingerprints binary, payload binary")


def key_bytes(keys: np.ndarray) -> list[bytes]:
    return [k.tobytes() for k in keys.astype("<i8")]


def key_prints(keys: list[bytes]) -> np.ndarray:
    return (hash_keys(keys, 0x5EED) >> np.uint64(32)).astype("<u4")


# ---- encoding


class WordEncoder:
    """Ids of whole texts by a byte-level tokenizer, a text being cut at blanks between characters that are not space.

    The tokenizer's own pattern always begins a pre-token at such a blank, so the ids are those of the whole text; each
    word goes through the library once and is remembered. Texts with other white space go through it whole.
    """

    def __init__(self, definition: str, width: int):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.width, self.kind = width, "<u2" if width == 2 else "<u4"
        self.words: dict[str, bytes] = {}
        self.held = 0
        # Ids that begin with a blank or a line feed, in the byte-level alphabet.
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for t, i in vocabulary.items() if t[:1] in ("\u0120", "\u010a")]] = True

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[str], mark: str) -> None:
        """Remember the ids of words that follow `mark`, a blank or a line feed; each begins with the only such id."""
        for at in range(0, len(words), AT_ONCE):
            some = words[at:at + AT_ONCE]
            packed = self.ids([mark + mark.join([w.removeprefix("\n\n") for w in some])])[0]
            cuts = (np.flatnonzero(self.begins[np.frombuffer(packed, self.kind)]) * self.width).tolist()
            self.words.update(zip(some, (packed[a:b] for a, b in zip(cuts, [*cuts[1:], len(packed)])), strict=True))
            self.held += len(packed) + sum(map(len, some)) + ENTRY * len(some)

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.held > WORDS:
            self.words.clear()
            self.held = 0
        # The first word of a line has no blank before it; it is kept under its text with two line feeds before it.
        cut = [f"\n\n{t.replace(LINE, LINE_WORD)}".split(" ") if t else [] for t in texts]
        missing = list(set().union(*cut).difference(self.words))
        good = [w for w in missing if len(w) <= REMEMBERED and regular(w)]
        self.learn([w for w in good if w[0] != "\n"], " ")
        self.learn([w for w in good if w[0] == "\n"], "\n")
        out, rest = [], []
        for k, words in enumerate(cut):
            try:
                # The line feed before the text is taken off again.
                out.append(b"".join(map(self.words.__getitem__, words))[self.width:])
            except KeyError:
                out.append(b"")
                rest.append(k)
        for k, whole in zip(rest, self.ids([texts[k] for k in rest])):
            out[k] = whole
        return out


def regular(word: str) -> bool:
    """Is it a word, or the first word of a line after its line feeds, without white space in it?"""
    body = word.removeprefix("\n\n")
    return body.split() == [body]


def pack(part: int, shard: int, keys: list[int | None], payloads: list[bytes], width: int) -> dict:
    """A shard's row. Keys may repeat and be null; the index leads to the first document of a key."""
    known = np.array([k is not None for k in keys], bool)
    values = np.array([0 if k is None else k for k in keys], np.int64)
    numbers = np.flatnonzero(known)
    distinct, first = np.unique(values[known], return_index=True)
    names = key_bytes(distinct)
    index = PerfectHash.build(names)
    slots = index.slots(hash_keys(names, index.seed))
    at, prints = np.zeros(len(names), "<u4"), np.zeros(len(names), "<u4")
    at[slots], prints[slots] = numbers[first], key_prints(names)
    sizes = np.array([len(p) // width for p in payloads], np.int64)
    return {"part": part, "shard": shard, "docs": len(keys), "ids": int(sizes.sum()), "width": width, "seed": index.seed,
            "least": int(distinct[0]) if len(distinct) else None, "most": int(distinct[-1]) if len(distinct) else None,
            "keys": values.astype("<i8").tobytes(), "known": np.packbits(known).tobytes(),
            "bounds": np.append(0, np.cumsum(sizes)).astype("<i8").tobytes(),
            "displacement": index.displacement.astype("<i8").tobytes(), "numbers": at.tobytes(),
            "fingerprints": prints.tobytes(), "payload": b"".join(payloads)}


class Shard:
    """A shard as read back."""

    def __init__(self, row: dict):
        self.row = row
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.known = np.unpackbits(np.frombuffer(row["known"], np.uint8), count=row["docs"]).astype(bool)
        self.bounds = np.frombuffer(row["bounds"], "<i8")
        self.numbers, self.prints = (np.frombuffer(row[c], "<u4") for c in ("numbers", "fingerprints"))
        self.index = PerfectHash(len(self.numbers), row["seed"], np.frombuffer(row["displacement"], "<i8"))
        self.payload = np.frombuffer(row["payload"], "<u2" if row["width"] == 2 else "<u4")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of the first document of each key, -1 where the stored fingerprint differs."""
        if not len(self.numbers) or not len(keys):
            return np.full(len(keys), -1)
        names = key_bytes(keys)
        slots = self.index.slots(hash_keys(names, self.index.seed))
        return np.where(self.prints[slots] == key_prints(names), self.numbers[slots].astype(np.int64), -1)

    def ids(self, number: int) -> np.ndarray:
        return self.payload[self.bounds[number]:self.bounds[number + 1]]


# ---- jobs


def write(docs: DataFrame, path: str, tokenizer_file: str, end_id: int) -> None:
    """Encode `docs` (doc_id, text) and write the store, each document followed by `end_id`.

    Rows are ordered by doc_id, nulls first, and equal ids by their texts' hashes, so that a hot id is dealt out too.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = f.read()
    spark = docs.sparkSession
    width = 2 if max(Tokenizer.from_str(definition).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    shared = spark.sparkContext.broadcast(definition)
    end = end_id.to_bytes(width, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state("tokenizer")
        keys, payloads, size, shard = [], [], 0, 0
        for batch in batches:
            if shared.value not in state:
                state.clear()
                state[shared.value] = WordEncoder(shared.value, width)
            ids = state[shared.value].encode(batch.column("text").to_pylist())
            for part, key, packed in zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), ids):
                keys.append(key)
                payloads.append(packed + end)
                size += len(payloads[-1])
                if size >= SHARD_IDS * width:
                    yield _rows([pack(part, shard, keys, payloads, width)])
                    keys, payloads, size, shard = [], [], 0, shard + 1
        if keys:
            yield _rows([pack(part, shard, keys, payloads, width)])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")) \
        .withColumn("tie", F.xxhash64("text")) \
        .repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie") \
        .select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "text") \
        .mapInArrow(run, SHARD).write.parquet(path)


def _rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in SHARD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[k]) for n, k in fields], [n for n, _ in fields])


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """Per shard: the number of ids before it, from sums by part and then within each part."""
    sizes = read_shards(spark, path).select("part", "shard", "ids")
    before = (Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*before)), F.lit(0)).alias("base"))
    within = F.coalesce(F.sum("ids").over(Window.partitionBy("part").orderBy("shard").rowsBetween(*before)), F.lit(0))
    return sizes.select("part", "shard", within.alias("inner")).join(parts, "part") \
        .select("part", "shard", (F.col("base") + F.col("inner")).alias("start"))


def _all_documents(s: Shard) -> list[tuple]:
    """Every document, each found through the index; repeats of a key follow its first document."""
    numbers = np.arange(s.row["docs"])
    first = s.find(s.keys[s.known])
    ordinal = numbers[s.known]
    # The index must lead to the document itself or, for a repeated key, to an earlier one with the same key.
    if (first < 0).any() or (s.keys[first] != s.keys[ordinal]).any() or (first > ordinal).any():
        raise ValueError("the index of a shard doesn't lead to its documents")
    repeat = np.zeros(len(numbers), np.int64)
    repeat[s.known] = ordinal - first
    lead = numbers.copy()
    lead[s.known] = first
    out = []
    for number, key, known in zip((lead + repeat).tolist(), s.keys.tolist(), s.known.tolist()):
        ids = s.ids(number)
        out.append((s.row["part"], s.row["shard"], key if known else None, int(s.bounds[number]), len(ids),
                    zlib.crc32(ids.astype("<u4").tobytes())))
    return out


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read from the files."""
    names = ["part", "shard", "doc_id", "inner", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*_all_documents(Shard(row)))], names)

    rows = read_shards(spark, path).mapInArrow(run, ", ".join(f"{n} long" for n in names))
    return rows.join(starts(spark, path), ["part", "shard"]) \
        .select("doc_id", (F.col("start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """(doc_id, ids): for each distinct key of `keys` (doc_id) that is stored, the ids of its first document.

    A sorted table of shard borders, thinned to a fixed number, routes keys and shards to a common number; keys then
    probe the index of each shard that may hold them. Null keys and keys that are not stored give no row.
    """
    shards = read_shards(spark, path)
    borders = shards.select("least").where("least is not null").distinct()
    share = max(1, -(-borders.count() // ROUTES))
    kept = [r[0] for r in borders.where(F.pmod(F.xxhash64("least"), F.lit(share)) == 0).orderBy("least").collect()]
    table = spark.sparkContext.broadcast(np.array(kept, np.int64))

    def route(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array(np.searchsorted(table.value, b.to_numpy(zero_copy_only=False), side="right").astype(np.int64))

    route.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    routed = F.arrow_udf(route, "long")
    wanted = keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct() \
        .withColumn("route", routed("doc_id"))
    spans = shards.where("least is not null").select("part", "shard", "least", "most") \
        .select("*", F.explode(F.sequence(routed("least"), routed("most"))).alias("route"))
    asked = wanted.join(spans, "route").where("doc_id between least and most") \
        .groupBy("part", "shard").agg(F.collect_list("doc_id").alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = Shard(row)
                asked_keys = np.array(row["asked"], np.int64)
                numbers = s.find(asked_keys)
                hit = [(k, n) for k, n in zip(asked_keys.tolist(), numbers.tolist()) if n >= 0 and s.keys[n] == k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(hit), pa.int64()), pa.array([row["shard"]] * len(hit), pa.int64()),
                     pa.array([k for k, _ in hit], pa.int64()),
                     pa.array([s.ids(n).astype(np.int32).tolist() for _, n in hit], pa.list_(pa.int32()))],
                    ["part", "shard", "doc_id", "ids"])

    found = shards.join(asked, ["part", "shard"]).mapInArrow(run, "part long, shard long, doc_id long, ids array<int>")
    # A key with so many documents that they fill shards is found in several; the first holds its first document.
    return found.groupBy("doc_id").agg(F.min_by("ids", F.struct("part", "shard")).alias("ids"))
