"""Line dedup: drop lines that occur earlier in the corpus, letter by letter or within a few edits.

Built-in functions only. A line of n characters is cut in `distance` + 1 segments of nearly equal length; of two lines
within the distance, one has a whole segment of the other, near its place. So each distinct line is put in an index
under (its length, the segment's number, the segment) and asks it for every length up to its own that the distance
allows, with the substrings at those places that an alignment of the rest leaves possible. Pairs that meet are verified
by an edit distance in which the deltas of a column's band of 2 * distance + 1 cells are the bits of two integers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import fresh, text_or_empty
from shoplens.llm.decontaminate import maybe_broadcast, text_key
from shoplens.session import durable, fits_broadcast, scratch_path

DISTANCE = 2
# Shorter lines are not compared by edits: a few make other lines of them.
MIN_CHARS = 25
# Equal lines go from this length on where the whole corpus is deduplicated; lines without a word are left alone.
MIN_EQUAL = 1
# Pieces in which a candidate is looked at before its distance is computed.
PIECES = 16
# Letters whose counts tell candidates apart (in texts without them, they tell nothing apart, and lose nothing); each costs
# a pass over every line.
LETTERS = "eta"
# Classes of letters whose counts tell apart the few lines that meet others.
CLASSES = ("a", "e", "i", "o", "u", "n", "s", "t", "r", "l", "d", "ch", "mp", "gbf", "vwky", "jqxz\u00e4\u00e9\u00f6\u00fc")


# ---- banded bit-parallel edit distance


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def within(a: Column, b: Column, distance: int) -> Column:
    """Is the edit distance of two strings at most `distance`?

    Column by column of b, bit k of the band is row j - distance + k of a (j from 1). vp and vn hold where a value is one
    more or one less than that above it; d follows the lowest diagonal of the band to the last row of a, then that row.
    """
    t = distance
    top, ones = 1 << 2 * t, (1 << 2 * t + 1) - 1
    nothing = F.array_repeat(F.lit(""), 2 * t)
    start = F.struct(F.lit(ones & ~((1 << t) - 1)).alias("vp"), F.lit(0).alias("vn"), F.lit(t).alias("d"), F.lit(1).alias("j"))

    def distance_of(v: Column) -> Column:
        def step(s: Column, c: Column) -> Column:
            match = F.when(F.get(v["rows"], s["j"] - 1) == c, 1).otherwise(0)
            for k in range(1, 2 * t + 1):
                match = match + F.when(F.get(v["rows"], s["j"] + (k - 1)) == c, 1 << k).otherwise(0)
            equal = lambda x: (x.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"]).bitwiseOR(x).bitwiseOR(s["vn"]).bitwiseAND(F.lit(ones))
            return let(let(match, equal), lambda d0: _advance(s, d0, v["m"], t, top, ones))

        return F.aggregate(v["columns"], start, step)["d"]

    m, n = F.char_length(a), F.char_length(b)
    frame = F.struct(m.alias("m"), F.concat(F.slice(nothing, 1, t), F.split(a, ""), nothing).alias("rows"), F.split(b, "").alias("columns"))
    return F.when(F.abs(m - n) > t, False).when((m <= t) | (n == 0), F.levenshtein(a, b) <= t).otherwise(let(frame, distance_of) <= t)


def _advance(s: Column, d0: Column, m: Column, t: int, top: int, ones: int) -> Column:
    """The next state, from the cells equal to their upper left neighbours."""
    vp, vn, j, d = s["vp"], s["vn"], s["j"], s["d"]
    plus = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp)).bitwiseAND(F.lit(ones)))

    def state(hp: Column) -> Column:
        hn, shifted = d0.bitwiseAND(vp), F.shiftright(d0, 1)
        # Bit of the last row of a in this column, once the diagonal has reached it.
        row = F.when(j + t <= m, top)
        for k in range(1, 2 * t + 1):
            row = row.when(j + t == m + k, top >> k)
        row = row.otherwise(0)
        right = F.when(hp.bitwiseAND(row) != 0, 1).when(hn.bitwiseAND(row) != 0, -1).otherwise(0)
        down = F.when(d0.bitwiseAND(F.lit(top)) != 0, 0).otherwise(1)
        return F.struct(
            hn.bitwiseOR(F.bitwise_not(shifted.bitwiseOR(hp)).bitwiseAND(F.lit(ones))).alias("vp"),
            shifted.bitwiseAND(hp).alias("vn"), F.when(j + t <= m, d + down).otherwise(d + right).alias("d"), (j + 1).alias("j"))

    return let(plus, state)


# ---- segments and the substrings that may meet them


def _segment(length: Column, i: int, pieces: int) -> tuple[Column, Column]:
    """Start (from 1) and length of segment i of a line; the last segments are one longer where need be."""
    longer = (length % pieces).cast("int")
    base = F.call_function("div", length, F.lit(pieces)).cast("int")
    before = F.greatest(F.lit(0), F.lit(i - pieces) + longer)
    return F.lit(1) + base * i + before, base + F.when(F.lit(i) >= pieces - longer, 1).otherwise(0)


def with_segments(lines: DataFrame, distance: int) -> DataFrame:
    """`lines` with the starts and sizes of the segments of lines of their own length and of those a few shorter.

    As columns they are computed once for all keys, and the generated code of the keys stays small enough to be compiled.
    """
    return lines.select("*", *[c.alias(f"{name}{shorter}_{i}") for shorter in range(distance + 1) for i in range(distance + 1)
                               for c, name in zip(_segment((F.col("n") - shorter).cast("int"), i, distance + 1), ("start", "size"))])


def keys(distance: int, min_chars: int) -> tuple[Column, Column, list[int]]:
    """Hashes under which a line is put in the index, those under which it asks, and which of these ask for its own length.

    Over the columns of `with_segments`; `min_chars` must be so large that every substring asked for lies in the line.
    """
    key = lambda shorter, i, shift: F.xxhash64(
        F.col("n") - shorter, F.lit(i), F.substring("line", F.col(f"start{shorter}_{i}") + shift, F.col(f"size{shorter}_{i}")))
    put, ask, level = [key(0, i, 0) for i in range(distance + 1)], [], []
    for i in range(distance + 1):
        for shorter in range(distance + 1):
            # Edits left of the segment are at most i, those right of it at most distance - i.
            for shift in range(max(-i, shorter - (distance - i)), min(i, shorter + distance - i) + 1):
                level += [len(ask)] if not shorter else []
                ask.append(F.when(F.col("n") >= min_chars + shorter, key(shorter, i, shift)) if shorter else key(0, i, shift))
    return F.array(*put), F.array(*ask), level


def letters(line: Column) -> Column:
    """Counts of some frequent letters, up to 127 each, in 7 bits each. An edit changes two of them by one at most."""
    packed = F.lit(0).cast("long")
    for letter in LETTERS:
        # Letters of one byte each, so bytes tell their number, which need no walk over the characters.
        many = F.least(F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit(""))), F.lit(127))
        packed = F.shiftleft(packed, 7) + many
    return packed


def letters_apart(a: Column, b: Column) -> Column:
    """Sum of the differences of two packed counts."""
    one = lambda x, k: F.shiftright(x, 7 * k).bitwiseAND(F.lit(127))
    return sum((F.abs(one(a, k) - one(b, k)) for k in range(1, len(LETTERS))), F.abs(one(a, 0) - one(b, 0)))


def spelling(line: Column) -> Column:
    """Counts of the letters of each class, modulo 16, in 4 bits each."""
    packed, n = F.lit(0).cast("long"), F.char_length(line)
    for letters_of in CLASSES:
        packed = F.shiftleft(packed, 4) + (n - F.char_length(F.translate(line, letters_of, ""))) % 16
    return packed


def spelt_apart(a: Column, b: Column) -> Column:
    """A lower bound of the sum of the differences of two lines' counts; an edit adds two at most."""
    total = F.lit(0)
    for k in range(len(CLASSES)):
        d = F.abs(F.shiftrightunsigned(a, 4 * k).bitwiseAND(F.lit(15)) - F.shiftrightunsigned(b, 4 * k).bitwiseAND(F.lit(15)))
        total = total + F.least(d, 16 - d)
    return total


def mostly_shared(a: Column, b: Column, distance: int) -> Column:
    """A cheap necessary condition: every edit spoils at most one of the PIECES pieces of b, the rest is in a nearby."""
    n, found = F.char_length(b), F.lit(0)
    for i in range(PIECES):
        start, size = _segment(n, i, PIECES)
        low = F.greatest(start - distance, F.lit(1))
        found = found + F.contains(F.substring(a, low, start + size + distance - low), F.substring(b, start, size)).cast("int")
    return found >= PIECES - distance


# ---- jobs


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS, min_equal: int | None = None) -> DataFrame:
    """(doc_id, k1, k2, at, h1, h2, n, line): the lines of at least `min_chars` characters, places from 0.

    With `min_equal`, also shorter ones of at least so many characters that hold something but white space.
    """
    texts = docs.select("doc_id", text_or_empty().alias("text")).select("doc_id", *text_key("text"), F.split("text", "\n").alias("l"))
    long = F.col("n") >= min_chars
    taken = long if min_equal is None else long | ((F.col("n") >= min_equal) & F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    lines = texts.select("doc_id", "k1", "k2", F.posexplode("l").alias("at", "line")).withColumn("n", F.char_length("line")).where(taken)
    h1, h2 = text_key("line")
    return lines.select("doc_id", "k1", "k2", "at", h1.alias("h1"), h2.alias("h2"), "n", "line")


def near_lines(firsts: DataFrame, distance: int, min_chars: int) -> DataFrame:
    """(h1, h2) of the distinct lines within `distance` edits of a line that first occurs before them.

    `firsts` has each distinct line once, at its first occurrence, with its `letters`. Lines that meet none under a key are left out by a
    semi-join, which gives no pairs. Of the rest, each is first compared with the earliest line of its keys alone; a line
    needs one witness, so only pairs whose later line has none yet are compared then. Crowds of lines that share a segment
    are told apart by letter counts within the joins.
    """
    put, ask, level = keys(distance, min_chars)
    cut = with_segments(firsts.select("h1", "n", "line", "letters"), distance)
    index = cut.select(F.col("h1").alias("a"), F.col("letters").alias("la"), F.explode(put).alias("key"))
    asked = cut.select(F.col("h1").alias("b"), F.col("letters").alias("lb"), F.posexplode(ask).alias("at", "key")).where("key is not null") \
        .select("b", "lb", F.col("at").isin(level).alias("level"), "key")
    # Of lines of equal length, it is enough that one asks.
    meets = F.when(F.col("level"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b")) \
        & (letters_apart(F.col("la"), F.col("lb")) <= 2 * distance)
    met = durable(asked.alias("x").join(index.alias("y"), (F.col("x.key") == F.col("y.key")) & meets, "left_semi").select("b", "level", "key"))
    held = durable(index.join(maybe_broadcast(met.select("key").distinct(), F.lit(8)), "key", "left_semi").select("a", "key"))
    named = met.select(F.col("b").alias("h1")).unionAll(held.select("a")).distinct()
    texts = durable(firsts.select("h1", "h2", F.struct("doc_id", "k1", "k2", "at").alias("first"), "line", spelling(F.col("line")).alias("spelling"))
                    .join(maybe_broadcast(named, F.lit(8)), "h1"))
    small = lambda frame: maybe_broadcast(frame, F.lit(96))
    about = lambda end: small(texts.select(F.col("h1").alias(end), F.col("first").alias(f"first_{end}"), F.col("spelling").alias(f"s{end}")))
    holders, askers = durable(held.join(about("a"), "a")), durable(met.join(about("b"), "b"))
    heads = holders.groupBy("key").agg(F.min_by(F.struct("a", "first_a", "sa"), "first_a").alias("head")).select("key", "head.*")
    one = durable(_near(askers.join(small(heads), "key"), texts, distance))
    done = one.select(F.col("h1").alias("seen"))
    mark = lambda frame, end: frame.join(small(done), F.col(end) == F.col("seen"), "left") \
        .withColumn(f"done_{end}", F.col("seen").isNotNull()).drop("seen")
    left = mark(askers, "b").join(mark(holders, "a"), "key") \
        .where(~F.when(F.col("first_a") < F.col("first_b"), F.col("done_b")).otherwise(F.col("done_a")))
    return one.unionAll(_near(left, texts, distance)).distinct()


def _near(candidates: DataFrame, texts: DataFrame, distance: int) -> DataFrame:
    """(h1, h2) of the later lines of those candidate pairs (a, b) that are within `distance` edits."""
    alike = F.when(F.col("level"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b")) & (spelt_apart(F.col("sa"), F.col("sb")) <= 2 * distance)
    pairs = durable(candidates.where(alike).select("a", "b", (F.col("first_a") < F.col("first_b")).alias("a_first")).distinct())
    side = lambda end: texts.select(F.col("h1").alias(end), F.col("h2").alias(f"{end}2"), F.col("line").alias(f"line_{end}"))
    hint = F.broadcast if fits_broadcast(texts, F.octet_length("line") + 80) else lambda frame: frame
    both = pairs.join(hint(side("a")), "a").join(hint(side("b")), "b")
    near = both.where(F.when(mostly_shared(F.col("line_a"), F.col("line_b"), distance),
                             within(F.col("line_a"), F.col("line_b"), distance)).otherwise(False))
    return near.select(F.when(F.col("a_first"), F.col("b")).otherwise(F.col("a")).alias("h1"),
                       F.when(F.col("a_first"), F.col("b2")).otherwise(F.col("a2")).alias("h2")).distinct()


def repeated_lines(docs: DataFrame, distance: int = DISTANCE, min_chars: int = MIN_CHARS, min_equal: int | None = None) -> DataFrame:
    """(doc_id, k1, k2, drop): places of the lines to drop, for each document that has any.

    Lines are ordered by doc_id (null first), the hashes of the text and place. A line is dropped if an equal line or,
    among lines of at least `min_chars` characters, one within `distance` edits comes before it.
    """
    lines = occurrences(docs, min_chars, min_equal)
    repeated = lines.select("h1", "h2", F.struct("doc_id", "k1", "k2", "at").alias("o")).groupBy("h1", "h2") \
        .agg(F.min("o").alias("first"), F.count("*").alias("times")).where("times > 1").select("h1", "h2", "first")
    repeated = maybe_broadcast(durable(repeated), F.lit(64))
    placed = lines.join(repeated, ["h1", "h2"], "left")
    later = F.col("first").isNotNull() & ~F.struct("doc_id", "k1", "k2", "at").eqNullSafe(F.col("first"))
    # Equal rows of documents hold the same first occurrence. Several passes read these lines, so they are written down.
    firsts = placed.where(~later & (F.col("n") >= min_chars)).drop("first") \
        .select("h1", "h2", "doc_id", "k1", "k2", "at", "n", "line", letters(F.col("line")).alias("letters"))
    path = scratch_path(docs.sparkSession, "lines")
    firsts.write.parquet(path)
    firsts = docs.sparkSession.read.schema(firsts.schema).parquet(path)
    near = durable(near_lines(firsts, distance, min_chars)).withColumn("near", F.lit(True))
    return placed.select("doc_id", "k1", "k2", "at", "h1", "h2", later.alias("later")) \
        .join(maybe_broadcast(near, F.lit(32)), ["h1", "h2"], "left").where("later or near") \
        .select("doc_id", "k1", "k2", "at").distinct().groupBy("doc_id", "k1", "k2").agg(F.collect_list("at").alias("drop"))


def dedup_lines(docs: DataFrame, distance: int = DISTANCE, min_chars: int = MIN_CHARS, min_equal: int | None = None) -> DataFrame:
    """`docs` with the repeated lines taken out of `text`; all rows and columns stay.

    A document whose lines are all repeated keeps an empty text; a null text stays null. Rows equal in doc_id and text
    count as one document and stay alike. Lines shorter than `min_chars` are dropped only with `min_equal`, and only as
    equals of an earlier line; those shorter than that and those of white space, empty ones too, are never dropped.
    """
    a, b, given, gone = fresh(docs.columns, "_k1", "_k2", "_id", "_drop")
    k1, k2 = text_key(text_or_empty())
    rows = docs.withColumns({a: k1, b: k2})
    drop = durable(repeated_lines(docs, distance, min_chars, min_equal)).toDF(given, f"{a}r", f"{b}r", gone)
    drop = maybe_broadcast(drop, F.size(gone) * 4 + 64)
    same = F.col("doc_id").eqNullSafe(F.col(given)) & (F.col(a) == F.col(f"{a}r")) & (F.col(b) == F.col(f"{b}r"))
    # Cut once, not once for each line that is kept.
    kept = lambda lines: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone)), lambda i: F.get(lines, i))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(let(F.split("text", "\n"), kept), "\n"))
    return rows.join(drop, same, "left").withColumn("text", text).select(*docs.columns)


def counted(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines, n_kept_lines and the text that is left."""
    n_lines = (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long")
    given = docs.select("doc_id", "text", F.coalesce(n_lines, F.lit(0)).alias("n_lines"))
    return dedup_lines(given, min_equal=MIN_EQUAL).select("doc_id", "n_lines", "text")
