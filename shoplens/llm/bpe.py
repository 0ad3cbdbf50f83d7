"""Byte-level BPE encoding and decoding by a rank file.

A pre-token that is itself in the vocabulary is found through a minimal perfect hash with one comparison of bytes; any
other is merged with a heap of candidate pairs over a doubly linked list of its bytes, lowest rank first and leftmost
among equals, so a piece of n bytes costs O(n log n). Short words seen before in the same Python worker are remembered, in
tables whose bytes are counted and bounded.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import fresh, text_or_empty, worker_state
from shoplens.llm.perfect_hash import PerfectHash

# Bytes of the pieces and words that a worker remembers, what an entry takes besides its characters and ids, and the
# characters beyond which a word is not remembered.
PIECES, WORDS = 48 << 20, 96 << 20
ENTRY, REMEMBERED = 220, 64


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file (base64 and rank on each line), in the order of their ids."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return [ranks[i] for i in range(len(ranks))]


class Vocabulary:
    """Tokens with their perfect hash. `merges` maps a pair of ids to the id of the joined token."""

    def __init__(self, tokens: list[bytes], index: PerfectHash):
        self.tokens, self.index = tokens, index
        ids = {t: i for i, t in enumerate(tokens)}
        self.at_slot = [0] * len(tokens)
        for t, i in ids.items():
            self.at_slot[index.slot(t)] = i
        self.bytes = [ids[bytes([b])] for b in range(256)]
        self.merges = {}
        for t, i in ids.items():
            for cut in range(1, len(t)):
                a, b = ids.get(t[:cut]), ids.get(t[cut:])
                if a is not None and b is not None:
                    self.merges[a, b] = i

    def encode_piece(self, piece: bytes) -> list[int]:
        i = self.at_slot[self.index.slot(piece)]
        return [i] if self.tokens[i] == piece else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        get, n = self.merges.get, len(piece)
        ids = list(map(self.bytes.__getitem__, piece))
        heap = [r << 32 | i for i, pair in enumerate(zip(ids, ids[1:])) if (r := get(pair)) is not None]
        if not heap:
            return ids
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            top = heappop(heap)
            new, i = top >> 32, top & 0xFFFFFFFF
            # The pair may have changed since it was put on the heap.
            if (j := after[i]) >= n or get((ids[i], ids[j])) != new:
                continue
            ids[i], ids[j] = new, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get((new, ids[k]))) is not None:
                    heappush(heap, r << 32 | i)
            if (k := before[i]) >= 0 and (r := get((ids[k], new))) is not None:
                heappush(heap, r << 32 | k)
        return [x for x in ids if x is not None]


class Irregular(Exception):
    """White space that the fast path does not cut."""


class Memo(dict):
    """Values made when first asked for; those of short keys are kept, and all forgotten when they reach `limit` bytes."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self.make, self.limit, self.held = make, limit, 0

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= REMEMBERED:
            self.held += ENTRY + 4 * len(key) + len(value)
            if self.held > self.limit:
                self.clear()
                self.held = 0
            self[key] = value
        return value


class Encoder:
    """Texts to packed little-endian 32-bit ids.

    A blank between two characters that are not white space always begins a pre-token, so a text can be cut there and
    the parts ("words") remembered; what contains other white space is cut by the pattern.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.pieces, self.words = Memo(self._piece, PIECES), Memo(self._word, WORDS)

    def _piece(self, piece: str) -> bytes:
        return array("I", self.vocabulary.encode_piece(piece.encode())).tobytes()

    def _word(self, word: str) -> bytes:
        if not regular(word):
            raise Irregular
        parts = self.pattern.findall(" " + word)
        if len(parts) > 1:
            return b"".join(map(self.pieces.__getitem__, parts))
        # Remembered as a word, not as a piece too.
        return self.pieces.get(parts[0]) or self._piece(parts[0])

    def by_pattern(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def _line(self, line: str) -> bytes:
        first, *rest = line.split(" ")
        if not regular(first):
            raise Irregular
        return self.by_pattern(first) + b"".join(map(self.words.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        try:
            return self.pieces["\n"].join([self._line(line) for line in text.split("\n")])
        except Irregular:
            return self.by_pattern(text)


def regular(word: str) -> bool:
    return bool(word) and not word[0].isspace() and not word[-1].isspace()


class Bpe:
    """Encoder and decoder for DataFrames; the vocabulary is read on the driver and broadcast (a bounded file).

    Only plain values are broadcast, so the package need not be installed where the tasks run.
    """

    def __init__(self, spark: SparkSession, rank_file: str, pattern: str):
        tokens = read_ranks(rank_file)
        index = PerfectHash.build(tokens)
        self.shared = spark.sparkContext.broadcast((tokens, index.seed, index.displacement))
        self.pattern, self.name = pattern, hashlib.sha256(b"\n".join(tokens)).hexdigest()

    def encode(self, df: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
        """`df` with a binary column of packed ids; a null or empty text has none. A column `ids` is replaced."""
        return df.withColumn(ids, self._coder(True, False)(text_or_empty(text)))

    def decode(self, df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
        """`df` with the bytes of packed ids; null is empty. Unknown ids are an error. A column `decoded` is replaced."""
        return df.withColumn(decoded, self._coder(False, True)(F.coalesce(F.col(ids), F.lit(b""))))

    def encode_and_decode(self, df: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
        """As `encode` and then `decode` of its ids, in one pass through Python."""
        both, = fresh([*df.columns, ids, decoded], "_both")
        rows = df.withColumn(both, self._coder(True, True)(text_or_empty(text)))
        return rows.withColumn(ids, F.col(both)["ids"]).withColumn(decoded, F.col(both)["decoded"]).drop(both)

    def _coder(self, encodes: bool, decodes: bool) -> Callable[[str | Column], Column]:
        shared, pattern, name = self.shared, self.pattern, self.name

        def decoded(packed: list[bytes]) -> pa.Array:
            token = shared.value[0].__getitem__
            return pa.array([b"".join(map(token, np.frombuffer(p, "<u4").tolist())) for p in packed], pa.binary())

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for given in batches:
                if not encodes:
                    yield decoded(given.to_pylist())
                    continue
                state, key = worker_state("bpe"), (name, pattern)
                if key not in state:
                    state.clear()
                    tokens, seed, displacement = shared.value
                    state[key] = Encoder(Vocabulary(tokens, PerfectHash(len(tokens), seed, displacement)), pattern)
                packed = [state[key].encode(t) for t in given.to_pylist()]
                ids = pa.array(packed, pa.binary())
                yield pa.StructArray.from_arrays([ids, decoded(packed)], ["ids", "decoded"]) if decodes else ids

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, "ids binary, decoded binary" if encodes and decodes else "binary")


def digests(bpe: Bpe, docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_tokens, SHA-256 of the packed ids and of the bytes they decode to.

    Repeated rows give repeated results, a null doc_id stays null, an empty table gives none.
    """
    ids, decoded = fresh(docs.columns, "ids", "decoded")
    rows = bpe.encode_and_decode(docs.select("doc_id", "text"), "text", ids, decoded)
    return rows.select("doc_id", F.shiftright(F.length(ids), 2).cast("long").alias("n_tokens"),
                       F.sha2(ids, 256).alias("ids_sha256"), F.sha2(decoded, 256).alias("decoded_sha256"))
