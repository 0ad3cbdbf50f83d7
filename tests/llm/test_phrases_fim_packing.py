"""Phrases, fill-in-middle and packing against plain versions, with nulls, long texts, ties, repeats and clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_llm_operators import low, same, tricky_rows
from tokenizers import Tokenizer

from shoplens.llm import fim, packing, phrases
from shoplens.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _made string, n int, _row int, length string, sequence_id int, phrase string"


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [(k, t, None if k in (3, 5) else "en" if (k or 0) % 3 else "fr", "s", 0, "m", 1, 2, "l", 3, "p") for k, t, *_ in tricky_rows()]
    rows += [(50 + k, t, "en", "s", 0, "m", 1, 2, "l", 3, "p") for k, t in enumerate(
        ["a\n\n\n\nb", "\n" * 70_000, "with a <P> mark\nhere", "<M>", "no break", "é\n漢字\n🙂🙂\n", "x y\n" * 40_000, "<\n>\n<S\n>"])]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def given(docs):
    return [(r["doc_id"], r["text"] or "", r["lang"] or "und") for r in docs.select("doc_id", "text", "lang").collect()]


# ---- phrases


def plain_phrases(given, min_count, inside=80, top=2000):
    counts, words = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in given:
        for piece in re.split("[.,;:!?\x0a-\x0d]", low(text)):
            w = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(w)
            for size in range(1, 5):
                counts[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        f = {p: n for p, n in f.items() if n >= min_count}
        found = []
        for p, a in f.items():
            if len(p) < 2:
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            longer = [n for q, n in f.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if not any(100 * n >= inside * a for n in longer):
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return out


@pytest.mark.parametrize("one_in", [1, 3, 1000])
def test_phrases_whatever_the_sample(docs, given, one_in):
    same(phrases.collocations(docs, min_count=4, one_in=one_in).collect(), plain_phrases(given, 4))


def test_phrases_of_a_top_and_of_nothing(docs, given):
    same(phrases.collocations(docs, min_count=3, top=7).collect(), plain_phrases(given, 3, top=7))
    assert phrases.collocations(docs.where("false")).count() == 0
    assert phrases.collocations(docs.where("text is null")).count() == 0


def test_phrases_missed_by_the_sample_are_counted_by_further_passes(docs, monkeypatch):
    passes = []
    real = phrases._counts
    monkeypatch.setattr(phrases, "_counts", lambda *a: passes.append(len(a)) or real(*a))
    whole = phrases.frequent(docs, 4, one_in=10 ** 9).select("lang", "phrase", "n").collect()
    # Words, pairs, triples and fours: each level comes from the border of the one before.
    assert len(passes) > 3
    same(whole, phrases.frequent(docs, 4, one_in=1).select("lang", "phrase", "n").collect())
    assert len({(r["lang"], r["phrase"]) for r in whole}) == len(whole)


def test_long_texts_are_cut_at_breaks_only(monkeypatch):
    monkeypatch.setattr(phrases, "SLAB_BYTES", 40)
    texts = ["one two three four. five six seven, eight nine ten eleven twelve thirteen fourteen fifteen", "", "A;b"]
    assert [x for s in phrases.slabs(texts) for x in s.split(b".") if x.strip()] == \
        [x.encode() for t in texts for x in re.split("[.,;]", t.lower()) if x.strip()]


# ---- fill-in-middle


@pytest.mark.parametrize("kind", ["sparse", "dense", "runs", "mixed"])
def test_boundary_set_selects_like_a_list(kind):
    rng = np.random.default_rng(4)
    members = {"sparse": np.unique(rng.integers(0, 1 << 20, 500)), "dense": np.flatnonzero(rng.random(196_608) < 0.4),
               "runs": np.concatenate([np.arange(5, 70_000), np.arange(140_000, 150_000)]),
               "mixed": np.concatenate([np.arange(3000), 65_536 + np.flatnonzero(rng.random(65_536) < 0.5), [300_000, 300_007]])}[kind]
    made = fim.BoundarySet(members)
    kinds = {type(c) for c in made.containers}
    assert {"sparse": {fim.ArrayContainer}, "dense": {fim.BitmapContainer}, "runs": {fim.RunContainer}}.get(kind, {
        fim.RunContainer, fim.BitmapContainer, fim.ArrayContainer}) == kinds
    assert len(made) == len(members)
    for k in {0, len(members) - 1, *rng.integers(0, len(members), 300).tolist()}:
        assert made.select(k) == members[k]
    for x in [0, 1 << 21, *rng.integers(0, 1 << 20, 300).tolist(), *members[:50].tolist()]:
        assert made.rank(x) == int((members < x).sum())
    with pytest.raises(IndexError):
        made.select(len(members))


def plain_fim(key, text):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 50 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle(docs, given):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(key, *plain_fim(key, text)[:4], sha(plain_fim(key, text)[4]), sha(text)) for key, text, _ in given]
    same(fim.digests(docs).collect(), want)
    assert {w[2] for w in want} == {"plain", "spm", "psm"}
    assert fim.digests(docs.where("false")).count() == 0
    made = fim.transform(docs)
    assert set(made.columns) == {*docs.columns, "n", "form", "prefix_chars", "middle_chars", "output"} and made.where("_made <> 'm'").count() == 0
    assert {r[0] for r in fim.transform(docs, rate=0).select("form").collect()} == {"plain"}


# ---- packing


def plain_pack(lengths, size):
    """Each piece where the sum of squares over all gaps is least, the whole sum computed anew each time."""
    gaps, out = [], []
    for x in lengths:
        best = None
        for gap in sorted({g for g in gaps if g >= x} | {size}):
            after = collections.Counter(g for g in gaps if g)
            if gap < size:
                after[gap] -= 1
            if gap - x:
                after[gap - x] += 1
            total = sum(v * v for v in after.values())
            if best is None or total < best[0]:
                best = total, gap
        gap = best[1]
        out.append(size - gap)
        if gap < size:
            gaps.remove(gap)
        gaps.append(gap - x)
    return out, sorted(gaps)


def test_sum_of_squares_is_least_at_each_step():
    rng = random.Random(8)
    for size in (5, 12, 30):
        for _ in range(20):
            lengths = [rng.randint(1, size - 1) for _ in range(60)]
            where, offset, gaps = packing.sum_of_squares(lengths, size)
            assert (offset.tolist(), sorted(gaps.tolist())) == plain_pack(lengths, size)
            used = collections.defaultdict(int)
            for k, x in zip(where.tolist(), lengths):
                used[k] += x
            assert [size - used[k] for k in range(len(gaps))] == gaps.tolist()


def check_places(rows, size):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_packing(docs, given):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want, total = [], 0
    for key, text, _ in given:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        total += len(ids)
        start, k = 0, 0
        while start < len(ids):
            end = start + ((len(ids) - start) % 2048 or 2048)
            want.append((key, k, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
            start, k = end, k + 1
    got = packing.report(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    same([r[:5] for r in got], want)
    assert check_places(got, 2048) <= -(-total // 2048) + 1
    assert packing.report(docs.where("false"), public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    kept = packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), 0))
    whole = packing.sequences(kept)
    assert whole.where("length(ids) <> 4 * n").count() == 0
    assert whole.agg(F.sum("n")).first()[0] == total


def test_packing_in_rounds(spark):
    """Many groups; repeated rows, clashing columns, pieces of which no two fit together, and full ones."""
    rng = random.Random(9)
    rows = [(7, rng.randint(1, 400), 1, 2, 3) for _ in range(3000)] + [(None, 500, 1, 2, 3)] * 40 + [(8, 1000, 1, 2, 3)] * 10
    items = spark.createDataFrame(rows, "doc_id long, length long, _row long, _group long, offset long").repartition(5)
    got = packing.pack(items, 1000, group=200).collect()
    same([r[:2] for r in got], [r[:2] for r in rows])
    assert check_places(got, 1000) <= 1.01 * sum(r[1] for r in rows) / 1000 + 1
    alone = spark.createDataFrame([(k, 600) for k in range(500)], "doc_id long, length long")
    assert check_places(packing.pack(alone, 1000, group=50).collect(), 1000) == 500
    with pytest.raises(PySparkException):
        packing.pack(spark.createDataFrame([(1, 0)], "doc_id long, length long"))
