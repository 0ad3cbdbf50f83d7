"""Fill-in-middle: texts are cut at boundaries of their units (lines) and put together again in another order.

The boundaries of a text, from 0 to its length in code points, are kept as a compressed set: the high 16 bits of a boundary
name its container, which holds the low 16 bits as a sorted array, a bitmap or runs, whichever is smallest, and containers
know how many members come before them. The k-th boundary is found by a search over these counts and a select within one
container, so any cut is found without going over the text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import fresh, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
LOW = 1 << 16


# ---- the boundary set


class ArrayContainer:
    """Sorted 16-bit values."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    @staticmethod
    def size(low: np.ndarray) -> int:
        return 2 * len(low)

    def select(self, k: int) -> int:
        return int(self.low[k])

    def rank(self, x: int) -> int:
        return int(np.searchsorted(self.low, x))


class BitmapContainer:
    """65 536 bits, with the number of members before each 64-bit word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(LOW, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @staticmethod
    def size(low: np.ndarray) -> int:
        return LOW // 8

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        rest = int(self.words[word])
        for _ in range(k - int(self.before[word])):
            rest &= rest - 1
        return word * 64 + (rest & -rest).bit_length() - 1

    def rank(self, x: int) -> int:
        word, bit = divmod(x, 64)
        if word >= len(self.words):
            return int(self.before[-1])
        return int(self.before[word]) + (int(self.words[word]) & ((1 << bit) - 1)).bit_count()


class RunContainer:
    """Starts of runs of consecutive values, with the number of members before each run."""

    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        self.starts = low[first].astype(np.int64)
        self.before = np.append(first, len(low))

    @staticmethod
    def size(low: np.ndarray) -> int:
        return 4 * int(np.count_nonzero(np.diff(low, prepend=-2) != 1))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])

    def rank(self, x: int) -> int:
        run = int(np.searchsorted(self.starts, x)) - 1
        if run < 0:
            return 0
        return min(int(self.before[run]) + x - int(self.starts[run]), int(self.before[run + 1]))


class BoundarySet:
    """An ascending set of non-negative integers in containers of 65 536 values each."""

    def __init__(self, members: np.ndarray):
        members = np.asarray(members, np.int64)
        high, low = members >> 16, members & (LOW - 1)
        self.keys, first = np.unique(high, return_index=True)
        self.before = np.append(first, len(members))
        self.containers = []
        for a, b in zip(self.before, self.before[1:]):
            part = low[a:b]
            kind = min((RunContainer, ArrayContainer, BitmapContainer), key=lambda c: c.size(part))  # noqa: B023
            self.containers.append(kind(part))

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The k-th member, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return (int(self.keys[at]) << 16) + self.containers[at].select(k - int(self.before[at]))

    def rank(self, x: int) -> int:
        """How many members are below x."""
        at = int(np.searchsorted(self.keys, x >> 16))
        if at == len(self.keys) or self.keys[at] != x >> 16:
            return int(self.before[at])
        return int(self.before[at]) + self.containers[at].rank(x & (LOW - 1))


def line_boundaries(text: str) -> BoundarySet:
    """0 and the ends of the lines in code points; a line ends after its line feed or with the text."""
    ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") == 10) + 1
    if text and text[-1] != "\n":
        ends = np.append(ends, len(text))
    return BoundarySet(np.concatenate([[0], ends]))


# ---- columns


MADE = "n long, form string, prefix_chars long, middle_chars long, output string"


def rearranged(text: str, digest: str, rate: int, spm_rate: int) -> tuple[int, str, int | None, int | None, str]:
    """A row of MADE: the four numbers at the head of a hexadecimal digest choose two boundaries and the form."""
    h = [int(digest[at:at + 8], 16) for at in range(0, 32, 8)]
    bounds = line_boundaries(text)
    n = len(bounds) - 1
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    first, second = map(bounds.select, sorted((h[0] % (n + 1), h[1] % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h[3] % 100 < spm_rate:
        return n, "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _made(text: Column, digest: Column, rate: int, spm_rate: int) -> Column:
    names = [f.split()[0] for f in MADE.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, digests in batches:
            rows = [rearranged(t, d, rate, spm_rate) for t, d in zip(texts.to_pylist(), digests.to_pylist())]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, MADE)(text, digest)


def _after(text: Column, mark: str, start: Column | int = 1) -> Column:
    """Place of the first character behind the first `mark` at or behind `start`."""
    return F.call_function("locate", F.lit(mark), text, F.lit(start) if isinstance(start, int) else start) + len(mark)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from: the marks are found again, and the parts put in their first order."""
    until = lambda start, end: F.substring(output, start, end - start)
    rest = F.lit(1 << 30)
    p, s, m = (_after(output, mark) for mark in (PREFIX, SUFFIX, MIDDLE))
    psm = F.concat(until(p, s - len(SUFFIX)), F.substring(output, m, rest), until(s, m - len(MIDDLE)))
    spm = F.concat(until(p, m - len(MIDDLE)), F.substring(output, m, rest), until(s, p - len(PREFIX)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


# ---- jobs


def transform(docs: DataFrame, rate: int = 100, spm_rate: int = 50, seed: int = SEED) -> DataFrame:
    """`docs` (doc_id, text and others) with n, form, prefix_chars, middle_chars and output.

    Where a text is cut and in which form follows from the hash of seed and doc_id alone, so equal ids cut alike; a null id
    counts as an empty one. `rate` and `spm_rate` are in per cent. A null text counts as empty; empty texts and those that
    hold a mark stay plain, with null counts of characters. Repeated rows give repeated results, an empty table none.
    Columns of these five names are replaced, all others stay.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    made, = fresh(docs.columns, "_made")
    rows = docs.withColumn(made, _made(text_or_empty(), digest, rate, spm_rate))
    names = [f.split()[0] for f in MADE.split(", ")]
    return rows.withColumns({name: F.col(made)[name] for name in names}).drop(made)


def digests(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars and the SHA-256 of the output and of the text restored from it."""
    rows = transform(docs.select("doc_id", "text"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))
