"""Places where an operator once did less than the whole job."""

import random

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from test_llm_operators import SF, SPACE_WORD, edits_within, same

from shoplens.llm import decontaminate, htmltext, langid, linededup


def plain_whole_dedup(rows):
    """As plain_line_dedup, with no bound of length for equal lines that hold a word."""
    kept, long, seen = {}, [], set()
    for key, text, k1, k2 in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3])):
        if (key, text) in kept:
            continue
        out = []
        for line in (text or "").split("\n"):
            gone = line in seen and bool(SPACE_WORD.search(line) or len(line) >= linededup.MIN_CHARS)
            seen.add(line)
            if len(line) >= linededup.MIN_CHARS:
                gone = gone or any(abs(len(line) - len(x)) <= 2 and edits_within(line, x, 2) for x in long)
                long.append(line)
            if not gone:
                out.append(line)
        kept[key, text] = None if text is None else "\n".join(out)
    return kept


def test_short_equal_lines_are_repeats(spark):
    made = [(0, "Of.\nA line of more than twenty-five characters.\n\nOf."), (1, "Of.\nA line of more than twenty-five characters.\n\nOf."),
            (2, "On.\nOf.\n \n "), (None, "On."), (3, None), (4, "")]
    for rows in (made, [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]):
        frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.char_length("text").cast("long"))
        keyed = frame.select("doc_id", "text", *decontaminate.text_key(F.coalesce("text", F.lit("")))).collect()
        want = plain_whole_dedup([tuple(r) for r in keyed])
        same(linededup.counted(frame).select("doc_id", "text").collect(), [(k, want[k, t]) for k, t in rows])
        same(corpus_pipeline.line_dedup(spark, frame, SF).select("doc_id", "text").collect(), [(k, want[k, t]) for k, t in rows])
    # The copy keeps only its empty line, and so is no document of its own.
    assert want and plain_whole_dedup([(k, t, 0, 0) for k, t in made])[1, made[1][1]].strip() == ""


def test_languages_count_by_their_text_not_their_share(spark, monkeypatch):
    """A minority of a thousandth and less of the rows, in a script of its own, and one with too little text to be learned."""
    monkeypatch.setattr(langid, "SLAB", 2)
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.col("lang").alias("said"), "source")
    many = real.where("said = 'en'").crossJoin(spark.range(60)).select(F.lit(0).cast("long").alias("doc_id"), F.substring("text", 1, 60).alias("text"), "said", "source")
    rng = random.Random(7)
    word = lambda first: "".join(chr(first + rng.randrange(24)) for _ in range(rng.randint(2, 5)))
    greek = [(1000 + k, " ".join(word(0x3B1) for _ in range(300)), "el", "s") for k in range(5)]
    rare = [(2000, " ".join(word(0x5D0) for _ in range(20)), "he", "s")]
    odd = [(3000, " ".join(word(0x430) for _ in range(60)), None, "s"), (3001, "%% 12", "he", "s")]
    frame = many.unionAll(real.select(F.lit(1).cast("long"), "text", "said", "source")).unionAll(
        spark.createDataFrame(greek + rare + odd, "doc_id long, text string, said string, source string"))
    assert 5 < 0.001 * frame.count()
    got = {r["doc_id"]: r for r in langid.identify(frame, F.col("said"), F.col("source"), F.lit(""), ["doc_id"]).where("doc_id >= 1000").collect()}
    assert all(got[k]["text_language"] == got[k]["language"] == "el" and got[k]["accepted"] for k, *_ in greek)
    assert got[2000]["language"] == "he" and got[2000]["accepted"]
    assert not got[3000]["accepted"] and not got[3001]["accepted"] and got[3001]["language"] is None
    alone = langid.identify(spark.createDataFrame(rare, "doc_id long, text string, said string, source string"), F.col("said"), F.col("source"), F.lit(""), ["doc_id"])
    assert [(r["language"], r["accepted"]) for r in alone.collect()] == [("he", True)]


def test_main_text_of_unmarked_pages_keeps_dense_blocks_of_any_tag():
    prose = lambda k: f"Sentence number {k} of a story that goes on for a good while, with words enough to be dense."
    part = lambda *ks: "<section>" + "".join(f"<p>{prose(k)}</p>" for k in ks) + "</section>"
    links = "<div class='x'>" + "".join(f"<a href='/{k}'>link {k}</a> " for k in range(12)) + "</div>"
    beside = [("ul", f"<li>{prose(10)}</li>"), ("blockquote", prose(11)), ("pre", prose(12)), ("table", f"<tr><td>{prose(13)}</td></tr>"), ("div", prose(14))]
    page = f"<body>{links}<div>{part(*range(20, 40))}{part(4, 5)}{''.join(f'<{t}>{x}</{t}>' for t, x in beside)}{prose(15)}</div>{links}</body>"
    assert htmltext.main_text(page) == "\n\n".join(map(prose, [*range(20, 40), 4, 5, 10, 11, 12, 13, 14, 15]))


def test_items_without_id_contaminate_too(spark):
    item = " ".join(f"word{k}" for k in range(12))
    docs = spark.createDataFrame([(1, f"before {item} after"), (2, "something else altogether")], "doc_id long, text string")
    items = spark.createDataFrame([(None, item)], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.clean(docs, items).collect()] == [2]
