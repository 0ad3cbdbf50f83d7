"""Licence notices as they stand in files: wrapped, chosen among, in long texts, repeated; and the paragraphs they stand in."""

import re
import textwrap

from pyspark.sql import functions as F
from test_llm_operators import SF

from shoplens.llm import licenses

MIT = """MIT License

Copyright (c) 2021 The Authors

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."""
BODY = {family: texts[0] for family, texts in licenses.NOTICES.items()}


def wrapped(text, width=76, mark=""):
    return "\n\n".join("\n".join(mark + line for line in textwrap.wrap(p, width)) for p in text.split("\n\n"))


def test_notices_in_files(spark):
    filler = "It was the time of the year in which all went out to the sea and came back late. " * 40
    cases = [("mit", wrapped(MIT)), ("mit", wrapped(BODY["mit"])), ("isc", wrapped(BODY["isc"])), ("bsd", wrapped(BODY["bsd"])),
             ("apache", wrapped(BODY["apache"], 70, "# ")), ("gpl", wrapped(BODY["gpl"], 60, " * ")), ("mpl", wrapped(BODY["mpl"], 40)),
             ("unlicense", BODY["unlicense"]), ("mit,unlicense", f"{BODY['mit']}\n\n{BODY['unlicense']}"),
             ("apache,mit", "Licensed under the MIT License or the Apache License, at your option."), ("lgpl", "Released under the GNU Lesser General Public License."),
             ("agpl", "Distributed under the GNU Affero General Public License."), ("cc-by-sa", "This work is licensed under a CC BY-SA 4.0."),
             ("isc", filler + BODY["isc"] + " " + filler), ("mit", filler + wrapped(BODY["mit"], 30) + "\n" + filler),
             ("", filler), ("", "My driving license was renewed under new rules."), ("", "Permission was granted to use the park.")]
    rows = [(10_000 + k, t) for k, (_, t) in enumerate(cases)] + [(None, cases[0][1]), (10_000, cases[0][1]), (20_000, None), (20_001, " \n\n ")]
    frame = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionAll(spark.createDataFrame(rows, "doc_id long, text string"))
    got = licenses.report(frame).where("doc_id >= 10000 or doc_id is null").collect()
    assert len(got) == len(rows)
    told = {r["doc_id"]: r["families"] for r in got}
    assert {k: told[10_000 + k] for k in range(len(cases))} == {k: f for k, (f, _) in enumerate(cases)}
    assert told[None] == "mit" and told[20_000] == told[20_001] == ""
    assert all(r["n_licensed"] <= r["n_paragraphs"] for r in got)


def test_paragraphs_end_at_blank_lines(spark):
    texts = ["", "one", "a\nb\n\nc", "a\n \t\nb\n\n\n\nc\n", "\n\n a \n\n", "a\r\n\r\nb", " ", "x" * 200_000 + "\n\n" + "y\n" * 50_000]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string")
    got = {r["k"]: r["p"] for r in frame.select("k", licenses.paragraphs(F.col("t")).alias("p")).collect()}
    for k, t in enumerate(texts):
        want = [[w for w in p.split("\n") if w.strip()] for p in re.split(r"\n(?:[ \t-\r]*\n)+", t) if p.strip(" \t\n\r\x0b\x0c")]
        assert [[w for w in p.split("\n") if w.strip()] for p in got[k]] == want


def test_the_sample_is_the_smallest_hashes_however_few_are_looked_at(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(licenses, "SAMPLE", 40)
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).where("char_length(line) > 20") \
        .where(~F.lower("line").rlike("licen[cs]|copyright|public domain|gpl|spdx|creative commons"))
    want = [r["line"][:licenses.SAMPLE_CHARS] for r in lines.orderBy(F.xxhash64("line"), "line").limit(40).collect()]
    assert licenses.sample_paragraphs(docs) == want and licenses.sample_paragraphs(docs.where("false")) == []
