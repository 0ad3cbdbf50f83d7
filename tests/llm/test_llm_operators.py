"""Each operator against a plain version on a small table with nulls, empty and long texts, ties and repeated rows."""

import base64
import collections
import hashlib
import html
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shoplens.llm import bpe, decontaminate, htmltext, langid, licenses, linededup, lm, quality, simhash, tokenstore
from shoplens.llm.common import prepare, worker_state
from shoplens.llm.perfect_hash import PerfectHash, hash_keys
from shoplens.session import scratch_path

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# Columns whose names clash with those that the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _k1 int, id string, line string, word string, ids string, key long"
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def tricky_rows():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeghilmnorst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    long = "\n".join(sentence(40) for _ in range(120))
    base = sentence(120)
    changed = base.split()
    changed[60] = "altered"
    line = sentence(30)
    texts = [None, "", "   \n\t ", "one", "Two words", "a b c", long, long, base, base, " ".join(changed), base.upper(),
             "É " + sentence(60) + "\r\n\r\nx  y z   漢字 🙂", f"{line}\n{line}\n{line}x\nshort\nshort\n\n", f"{sentence(9)}\n{line}",
             "the " * 400, "same same same same", sentence(70) + "\n" + "Released under the MIT License.", "%%% ### ***", "x" * 5000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, sentence(55)), (None, None), (8, base), (3, "another text of this id")]
    return [(k, t, "en", "s", 0, 1, "i", "l", "w", "d", 7) for k, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame(tricky_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def given(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def same(got, want):
    key = lambda row: [(x is None, str(type(x)), x) for x in row]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_perfect_hash_is_minimal():
    keys = [f"key {k}".encode() for k in range(5000)]
    index = PerfectHash.build(keys)
    assert sorted(index.slots(hash_keys(keys, index.seed))) == list(range(5000))
    assert [index.slot(k) for k in keys[:200]] == index.slots(hash_keys(keys[:200], index.seed)).tolist()
    assert PerfectHash.build([]).n == 0
    with pytest.raises(ValueError):
        PerfectHash.build([b"a", b"a"])


def reference_encoding():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, docs, given, nothing):
    codec, other = bpe.Bpe(spark, RANKS, public_tokenizers.PATTERN), reference_encoding()
    want = []
    for key, text in given:
        ids = np.array(other.encode_ordinary(text or ""), "<u4")
        want.append((key, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    same(bpe.digests(codec, docs).collect(), want)
    assert bpe.digests(codec, nothing).count() == 0
    assert codec.encode(docs).columns == docs.columns


def test_bpe_cuts_white_space_like_the_pattern():
    tokens = bpe.read_ranks(RANKS)
    mine, other, rng = bpe.Encoder(bpe.Vocabulary(tokens, PerfectHash.build(tokens)), public_tokenizers.PATTERN), reference_encoding(), random.Random(1)
    parts = ["a", "b1", " ", "  ", "\n", "\n\n", "\t", "'s", "é", " ", " ", "漢", "\x1c", "\x85", ".", " the", "\r\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == other.encode_ordinary(text), repr(text)


def test_edit_distance_by_bits(spark):
    rng = random.Random(2)
    pairs = [("abc", "abc"), ("", "ab"), ("ab", ""), ("a", "abc"), ("abcd", "abdc")]
    for _ in range(600):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "c"])
        pairs.append((a, "".join(b)))
    frame = spark.createDataFrame(pairs, "a string, b string")
    for distance in (1, 2, 3):
        told = frame.select(linededup.within(F.col("a"), F.col("b"), distance).alias("x"), (F.levenshtein("a", "b") <= distance).alias("y"))
        assert told.where("x <> y or x is null").count() == 0


def edits_within(a, b, most):
    """Dynamic programming over the cells near the diagonal, row by row."""
    row = {j: j for j in range(most + 1)}
    for i, c in enumerate(a, 1):
        above, row = row, {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            cells = [above[j] + 1] if j in above else []
            if j and j - 1 in above:
                cells.append(above[j - 1] + (c != b[j - 1]))
            if j - 1 in row:
                cells.append(row[j - 1] + 1)
            row[j] = min(cells)
        if not row or min(row.values()) > most:
            return False
    return row.get(len(b), most + 1) <= most


def plain_line_dedup(rows):
    """Texts by (doc_id, text), in the operator's order; rows equal in both are one document."""
    order, kept, lines = {}, {}, []
    for key, text, k1, k2 in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3])):
        if (key, text) in order:
            continue
        order[key, text] = True
        out = []
        for line in (text or "").split("\n"):
            if len(line) >= linededup.MIN_CHARS:
                near = any(abs(len(line) - len(x)) <= 2 and edits_within(line, x, 2) for x in lines)
                lines.append(line)
                if near:
                    continue
            out.append(line)
        kept[key, text] = None if text is None else "\n".join(out)
    return kept


def test_line_dedup(docs, given, nothing):
    keyed = docs.select("doc_id", "text", *decontaminate.text_key(F.coalesce("text", F.lit("")))).collect()
    want = plain_line_dedup([tuple(r) for r in keyed])
    out = linededup.dedup_lines(docs)
    assert out.columns == docs.columns
    same(out.select("doc_id", "text").collect(), [(k, want[k, t]) for k, t in given])
    assert linededup.dedup_lines(nothing).count() == 0


def test_line_dedup_finds_every_line_within_two_edits(spark):
    rng = random.Random(4)
    rows = []
    for k in range(40):
        line = "".join(rng.choice("abcd ") for _ in range(rng.randint(24, 60)))
        for _ in range(4):
            b = list(line)
            for _ in range(rng.randint(0, 3)):
                at = rng.randint(0, len(b) - 1)
                b[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "y"])
            rows.append((len(rows), "".join(b)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = frame.select("doc_id", "text", *decontaminate.text_key("text")).collect()
    want = plain_line_dedup([tuple(r) for r in keyed])
    same(linededup.dedup_lines(frame).collect(), [(k, want[k, t]) for k, t in rows])


PAGES = [
    ('<html lang="en"><head><title>T</title><script>if (a<b) "</p>"</script></head><body><nav><a href="/">Home</a></nav><div class="ad">Buy'
     '</div><article><h1>Head&amp;line</h1><p><b>First para<br><p>Second   para with <a href="x">link</a></p><ul><li>x<li>y</ul></article>'
     '<footer>&copy; me</footer></body></html>', "Head&line\n\nFirst para\n\nSecond para with link\n\nx\n\ny"),
    ('<body><div class="menu"><a>a</a></div><div class="story"><h1>Title</h1><p>Some long text of the story here.</p><p>More of the long text.</p>'
     '</div><div id="comments"><p>I do not agree with any of this story at all.</p></div><form><input><p>Send</p></form></body>',
     "Title\n\nSome long text of the story here.\n\nMore of the long text."),
    ("<main><header>Skip</header><p>Only &lt;this&gt; &#233;</p><aside>no</aside></main>", "Only <this> é"),
    ("", ""), (None, ""), ("plain text only", "plain text only"), ("<p>a<p>b &amp; c", "a\n\nb & c"), ("<div><div><div>", ""),
    ("<<<>>> </p></p></body>", "<<<>>>"), ("<div>" * 3000 + "<p>deep words</p>", "deep words"),
]


def test_main_text(spark):
    frame = spark.createDataFrame([(k, f"u{k}", h, "t") for k, (h, _) in enumerate([*PAGES, PAGES[0]])], "page_id long, url string, html string, text string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in htmltext.extract(frame).collect()}
    for k, (_, text) in enumerate([*PAGES, PAGES[0]]):
        assert got[k] == (text, len(text)), k
    assert htmltext.extract(frame.where("false")).count() == 0


def test_main_text_of_the_given_pages(spark):
    for row in htmltext.extract(spark.read.parquet(f"{SF}/pages.parquet")).join(
            spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search("<article>(.*?)</article>", row["html"], re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)>", article)]
        assert row["text"] == "\n\n".join(p for p in parts if p)


def test_license_scan(spark, docs, nothing):
    got = {r["doc_id"]: r for r in licenses.report(docs).collect() if r["doc_id"] is not None}
    assert {k for k, r in got.items() if r["n_licensed"]} == {17}
    assert (got[17]["families"], got[17]["n_licensed"], got[17]["n_paragraphs"]) == ("mit", 1, 1)
    assert licenses.report(nothing).count() == 0 and licenses.report(docs).count() == docs.count()


def test_license_families_held_out(spark):
    """Notices in words that the templates don't have, and sentences that only speak of licences."""
    texts = [("apache", "All files here are licensed under the Apache License, Version 2.0, see below."), ("mit", "Our code is released under the MIT License (2021)."),
             ("gpl", "This tool is distributed under the GNU General Public License, version 3 or later."), ("cc-by-nc", "Pictures: licensed under CC BY-NC 4.0, no exceptions."),
             ("", "My driving license was renewed under new rules."), ("", "The general public was free to use the park."), ("", "Copyright 2020, all rights reserved.")]
    frame = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionAll(
        spark.createDataFrame([(10_000 + k, f"Some words first.\n{t}") for k, (_, t) in enumerate(texts)], "doc_id long, text string"))
    got = {r["doc_id"]: r["families"] for r in licenses.report(frame).where("doc_id >= 10000").collect()}
    assert [got[10_000 + k] for k in range(len(texts))] == [f for f, _ in texts]


def test_language_id(spark, docs, nothing):
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    # Held out: one in four declarations is withheld, one in eight is wrong.
    spoilt = real.withColumn("said", F.when(F.col("doc_id") % 4 == 1, None).when(F.col("doc_id") % 8 == 2, "en").otherwise(F.col("lang")))
    got = langid.identify(spoilt, F.col("said"), F.col("source"), F.lit(""), ["doc_id", "lang"]).collect()
    assert sum(r["language"] == r["lang"] for r in got) >= 0.98 * len(got) and all(r["accepted"] for r in got)
    odd = docs.select("doc_id", F.col("text"), "source").unionAll(real.select(F.col("doc_id") + 1000, "text", "source"))
    odd = odd.withColumn("said", F.when(F.col("doc_id") >= 1000, F.lit("en")))
    told = langid.identify(odd, F.col("said"), F.lit(None).cast("string"), F.lit(None).cast("string"), ["doc_id"]).where("doc_id < 1000 or doc_id is null")
    assert told.count() == docs.count()
    silent = {r["doc_id"] for r in told.where("language is null").collect()}
    assert {0, 1, 2, 18} <= silent and not told.where("language is null and accepted").count()
    assert langid.identify(nothing, F.col("lang"), F.col("source"), F.lit(""), ["doc_id"]).count() == 0
    kept = langid.accepted(docs, F.col("lang"), F.col("source"), F.lit(""))
    assert kept.columns == docs.columns and kept.where("text is null or trim(text) = ''").count() == 0
    assert kept.where(F.length("text") > 500).count() == docs.where(F.length("text") > 500).count()


def test_host_prior_decides_where_the_text_does_not():
    assert len(langid.trigrams("")) == 0 and len(langid.trigrams("123 %%%")) == 0
    assert len(langid.trigrams("Ein Wort")) == len(langid.trigrams("ein   wort"))


def plain_quality(text):
    words = SPACE_WORD.findall(text or "")
    times = collections.Counter(zip(words, words[1:], words[2:]))
    hit = {k + j for k in range(len(words) - 2) if times[tuple(words[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if SPACE_WORD.search(x)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed


def test_quality_measures(spark, docs, given, nothing):
    labels = spark.createDataFrame([(6, 1, 0), (12, 1, 0), (15, 0, 1), (None, 1, 0), (12, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.judge(docs, labels)
    same(got.select("doc_id", *quality.MEASURES, "base_failed").collect(), [(k, *plain_quality(t)) for k, t in given])
    assert got.where("kept and base_failed").count() == 0
    assert quality.judge(nothing, labels).count() == 0
    assert quality.judge(docs, labels.where("false")).where("kept = base_failed").count() == 0


def test_quality_on_held_out_labels(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.judge(docs, labels.where("doc_id % 2 = 0")).join(labels, "doc_id").where("doc_id % 2 = 1 and not base_failed")
    right = got.where("(quality > 0) = kept").count()
    assert right >= 0.95 * got.count()


def plain_fingerprint(text):
    words = SPACE_WORD.findall(low(text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_simhash(docs, given, nothing):
    prints = [plain_fingerprint(t) for _, t in given]
    roots = plain_components(prints, 2)
    least = {}
    for (key, _), r in zip(given, roots):
        if key is not None:
            least[r] = min(key, least.get(r, key))
    same(simhash.components(docs).collect(), [(k, f"{f:016x}", least.get(r)) for (k, _), f, r in zip(given, prints, roots)])
    assert simhash.components(nothing).count() == 0


def test_operators_forget_what_an_earlier_one_has_built():
    """A worker serves one stage after the other; tables of the stage before must not stay in its memory."""
    nothing = pa.RecordBatch.from_pydict({"text": pa.array([], pa.string()), "declared": pa.array([], pa.string())})
    codes = pa.RecordBatch.from_pydict({"_key": pa.array([1, 1]), "fp": pa.array([1, 3])})
    for task in (lambda: langid._count(iter([nothing])), lambda: simhash._forests(2)(iter([codes]))):
        earlier = worker_state("bpe")
        earlier["table"] = bytes(10)
        list(task())
        assert worker_state("bpe") is not earlier and not worker_state("bpe")


def test_bpe_remembers_a_word_of_one_piece_once():
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoder = bpe.Encoder(bpe.Vocabulary(tokens, PerfectHash.build(tokens)), public_tokenizers.PATTERN)
    text = "Once qvxzzy upon, a time qvxzzy there's 12 \u00fcber-words"
    assert encoder.encode(text) == encoder.by_pattern(text)
    encoder.pieces.clear()
    encoder.words.clear()
    encoder.encode(text)
    assert {"qvxzzy", "a", "time"} <= set(encoder.words) and not {" " + w for w in encoder.words} & set(encoder.pieces)


def test_gray_index_is_exact_for_crowded_fingerprints(spark, monkeypatch):
    """Buckets larger than one piece are dealt again by their other bits."""
    monkeypatch.setattr(simhash, "BUCKET", 16)
    rng = np.random.default_rng(6)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    codes = set()
    for c in centres:
        for _ in range(150):
            codes.add(int(c ^ sum(np.uint64(1) << np.uint64(b) for b in set(rng.integers(0, 64, rng.integers(0, 5)).tolist()))))
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >= 1 << 63 else c for c in codes]
    frame = spark.createDataFrame([(c,) for c in signed], "fp long")
    root = {r["node"]: r["root"] for r in simhash.connect(simhash.near_edges(frame, 2)).collect()}
    want = plain_components(codes, 2)
    groups, mine = collections.defaultdict(set), collections.defaultdict(set)
    for c, w in zip(signed, want):
        groups[w].add(c)
        mine[root.get(c, c)].add(c)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_line_dedup_cuts_a_text_once_not_for_each_line_kept(spark):
    docs = spark.createDataFrame([(1, "one\ntwo\nthree"), (2, "four\ntwo\n\nfive\none"), (3, None), (4, "one\ntwo")], "doc_id long, text string")
    got = linededup.dedup_lines(docs, min_equal=1)
    assert "get(split(" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "one\ntwo\nthree", 2: "four\n\nfive", 3: None, 4: ""}


def plain_lm(rows):
    tokens = [[*SPACE_WORD.findall(low(t or "")), ""] for _, t in rows]
    held = [k is not None and zlib.crc32(str(k).encode()) % 5 == 1 for k, _ in rows]
    counts = collections.Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(k, h, len(ws), sum(w in counts for w in ws), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
            for (k, _), h, ws in zip(rows, held, tokens)]


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 3])
def test_lm_base(docs, given, nothing, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "LEAST_STEPS", 5)
    got = lm.score(docs, RANKS).collect()
    key = lambda r: tuple((x is None, x) for x in r[:4]) + (round(r[5], 6),)
    for mine, want in zip(sorted(map(tuple, got), key=key), sorted(plain_lm(given), key=key), strict=True):
        assert mine[:5] == want[:5] and math.isclose(mine[5], want[5], rel_tol=1e-9) and mine[6] < 0
    assert lm.score(nothing, RANKS).count() == 0


def test_subwords_are_the_longest_matches_and_few_places_are_searched(monkeypatch):
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    cutter, known = lm.Subwords(tokens), {t: i for i, t in enumerate(tokens) if len(t) <= lm.LONGEST}
    rng = np.random.default_rng(8)
    words = [b"", b"\x00\x00", "\u00fcber\u65e5\u672c".encode(), b"q" * 300, b""]
    words += [bytes(rng.choice(list(b"etaoinshrdlu"), rng.integers(1, 12)).tolist()) for _ in range(3000)]
    want = []
    for word in words:
        text, found = b" " + word if word else b"", [] if word else [cutter.end]
        while text:
            size = max(k for k in range(1, lm.LONGEST + 1) if text[:k] in known and k <= len(text))
            found.append(known[text[:size]])
            text = text[size:]
        want.append(found)
    searched, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *more: searched.append(len(v)) or search(a, v, *more))
    sizes, flat = cutter.cut(words)
    assert sizes.tolist() == [len(f) for f in want] and flat.tolist() == [i for f in want for i in f]
    assert sum(searched) < 2 * len(flat)


def test_lm_beats_the_base_on_held_out_documents(spark):
    got = lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), RANKS).where("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got["s"] > got["b"]


def test_lm_does_not_depend_on_the_files(spark, monkeypatch):
    """Several shards, and the same scores whatever the order of rows and the number of partitions."""
    monkeypatch.setattr(lm, "SHARD", 100)
    monkeypatch.setattr(lm, "LEAST_STEPS", 5)
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    one, two = ({r["doc_id"]: r["score"] for r in lm.score(d, RANKS).collect()} for d in (rows.coalesce(1), rows.orderBy(F.desc("n_chars")).repartition(7)))
    assert one.keys() == two.keys() and all(math.isclose(one[k], two[k], rel_tol=1e-6) for k in one)


def test_lm_learns_from_every_subword_of_every_training_text(spark):
    texts = [" ".join(f"word{i}x{k}" for i in range(n)) for k, n in enumerate((0, 1, 5, 300, 2000))] + [None, "a" * 20_000, "\u00e9t\u00e9 \n " * 500]
    docs = spark.createDataFrame(list(enumerate(t or "" for t in texts)), "doc_id long, text string").repartition(3)
    tokens = lm.read_ranks(RANKS)
    end, cutter = len(tokens), lm.Subwords(tokens)
    rows = lm.training_windows(docs, tokens).collect()
    inputs, targets = lm.unpack([bytes(r["stretch"]) for r in rows], end)
    goals = targets[:, lm.CONTEXT:]
    _, _, _, _, flat = lm.stream([t or "" for t in texts], cutter)
    assert np.array_equal(np.bincount(goals[goals >= 0], minlength=end + 1), np.bincount(flat, minlength=end + 1))
    # The windows are those in which texts are scored.
    _, _, per_text, per_word, flat = lm.stream([t or "" for t in texts], cutter)
    sizes = np.add.reduceat(per_word, np.cumsum(per_text) - per_text)
    want = lm.windows(flat, sizes, end)[:2]
    both = lambda x: sorted(map(tuple, np.concatenate(x, axis=1).tolist()))
    assert both((inputs, targets)) == both(want)


def test_lm_shards_may_be_taken_in_parts(spark, monkeypatch):
    """Equal rows share a shard; what is learned counts each of their windows."""
    monkeypatch.setattr(lm, "SHARD", 2)
    monkeypatch.setattr(lm, "LEAST_STEPS", 1)
    docs = spark.createDataFrame([(7, "one two three four " * 40)] * 30, "doc_id long, text string")
    got = lm.score(docs, RANKS).collect()
    assert len(got) == 30 and len({(r["score"], r["base_score"]) for r in got}) == 1 and got[0]["score"] < 0


def test_words_that_begin_alike_share_what_their_first_subword_gets():
    """What known words get for their counts, and what discounts leave for spellings, adds up to one."""
    counts, first = np.array([5.0, 1.0, 3.0]), 0.25
    begun, words = counts.sum(), len(counts)
    left = lm.DISCOUNT * words / begun
    assert math.isclose(first * ((counts - lm.DISCOUNT) / begun).sum() + first * left, first)


def test_attention_sees_only_the_past_and_scores_each_place_once():
    sizes = np.array([1, 30, 200])
    ids = np.arange(231)
    inputs, targets, places = lm.windows(ids, sizes, 999)
    assert sorted(places[places >= 0]) == list(range(231))
    rng = np.random.default_rng(1)
    own, experts = rng.integers(0, lm.OWN, 1000), rng.random((1000, lm.EXPERTS))
    model = lm.Attention.fresh(own, (experts / experts.sum(axis=0)).astype(np.float32), np.full(lm.EXPERTS, 1 / lm.EXPERTS))
    model.tables()
    one = model.score(ids, sizes, 999)
    later = ids.copy()
    later[100:] = 5
    assert np.allclose(one[:100], model.score(later, sizes, 999)[:100], atol=1e-5)
    loss, g, held = model.gradients(inputs, targets)
    assert math.isclose(loss, -one.mean(), rel_tol=1e-4)
    assert np.allclose(held.sum(axis=2), targets[:, lm.CONTEXT:] >= 0, atol=1e-4)
    for name in model.NAMES:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        held, losses = model.p[name][at], []
        for step in (0.01, -0.01):
            model.p[name][at] = held + step
            losses.append(model.gradients(inputs, targets)[0])
        model.p[name][at] = held
        assert math.isclose((losses[0] - losses[1]) / 0.02, g[name][at], rel_tol=0.05, abs_tol=1e-4)


def test_token_store(spark, docs, nothing, given, monkeypatch):
    monkeypatch.setattr(tokenstore, "SHARD_IDS", 600)
    definition = public_tokenizers.path("byte_bpe_50k.json")
    other, path = Tokenizer.from_file(definition), scratch_path(spark, "store")
    tokenstore.write(docs, path, definition, 2)
    got = tokenstore.documents(spark, path).collect()
    ids = {t: other.encode(t, add_special_tokens=False).ids + [2] for t in {t or "" for _, t in given}}
    crc = lambda t: zlib.crc32(np.array(ids[t or ""], "<u4").tobytes())
    same([(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got], [(k, len(ids[t or ""]), crc(t)) for k, t in given])
    # Starts follow on one another in ascending order of the keys.
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == np.cumsum([0, *(r["n_tokens"] for r in ordered)])[:-1].tolist()
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in ordered]
    assert keys == sorted(keys)
    wanted = spark.createDataFrame([(k,) for k in [*range(30), None, 5, -7, 10**12]], "doc_id long")
    found = {r["doc_id"]: r["ids"] for r in tokenstore.lookup(spark, path, wanted).collect()}
    first = {r["doc_id"]: r["ids_crc32"] for r in reversed(ordered)}
    assert set(found) == {k for k, _ in given if k is not None}
    assert all(zlib.crc32(np.array(v, "<u4").tobytes()) == first[k] for k, v in found.items())
    empty = scratch_path(spark, "store")
    tokenstore.write(nothing, empty, definition, 2)
    assert tokenstore.documents(spark, empty).count() == 0 and tokenstore.lookup(spark, empty, wanted).count() == 0


def test_word_encoder_equals_the_library():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    mine, other, rng = tokenstore.WordEncoder(definition, 2), Tokenizer.from_str(definition), random.Random(5)
    other.encode_special_tokens = True
    parts = [*"ab1 .,\n\t'é  漢\x1c\x85", "<|endoftext|>", "  ", "\n\n", "\r\n", " the", "'s "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for text, ids in zip(texts, mine.encode(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == other.encode(text, add_special_tokens=False).ids, repr(text)


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_hits(rows, items):
    found = collections.defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(low(text or ""))
        if w:
            for k in range(max(1, len(w) - 9)):
                found[tuple(w[k:k + 10])] |= set() if item is None else {str(item)}
    out = []
    for key, text in rows:
        w, hit, ids = ALNUM.findall(low(text or "")), set(), set()
        for size in {len(x) for x in found}:
            for k in range(len(w) - size + 1):
                if (here := found.get(tuple(w[k:k + size]))) is not None:
                    hit |= set(range(k, k + size))
                    ids |= here
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(ids), digest, bool(hit)))
    return out


def test_decontamination(spark, docs, given, nothing):
    texts = {k: t for k, t in given}
    long, base = texts[6].replace("\n", ", "), texts[9]
    items = [(1, " ".join(long.split()[50:75])), (2, base.upper()), (3, "same same"), (11, " ".join(base.split()[20:30])), (None, base), (4, None),
             (5, "..."), (6, "words that no document has anywhere at all in it"), (7, " ".join(long.split()[50:75])), (7, "same same same")]
    frame = spark.createDataFrame([(*i, "w") for i in items], "item_id long, text string, word string")
    same(decontaminate.report(docs, frame).collect(), plain_hits(given, items))
    clean = decontaminate.clean(docs, frame)
    assert clean.columns == docs.columns
    same(clean.select("doc_id", "text").collect(), [(k, t) for (k, t), r in zip(given, plain_hits(given, items)) if not r[5]])
    assert decontaminate.report(nothing, frame).count() == 0
    assert decontaminate.report(docs, frame.where("false")).where("contaminated").count() == 0


def test_words_follow_the_pattern(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("aB1 .,@[`{é \x7f\n_É") for _ in range(rng.randint(0, 12))) for _ in range(500)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select("text", decontaminate.words().alias("w"))
    for row in frame.collect():
        assert row["w"] == ALNUM.findall(low(row["text"])), repr(row["text"])
