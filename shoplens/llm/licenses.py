"""Licence scan: a paragraph classifier over sparse word n-grams, and a comparison with the templates that confirms it.

Scanning uses built-in functions only. A paragraph ends at a blank line, so notices wrapped at any width are put together
again; it is looked at in overlapping runs of words, longer than any template, so that long ones don't dilute a notice. Of the
most probable families of a run, the first that a template confirms is its licence; a further one, as in a choice of licences, by a whole name of it that the
first one's templates don't explain. The classifier is a multinomial logistic regression, fitted on the driver on
notices made from the templates below and on a bounded sample of the corpus' paragraphs as the class "unknown"; its
features are n-grams of the templates that hold a telling word, one that the sample doesn't use freely. A text without
telling words has no features, so only documents with one are cut in paragraphs. The temperature of the probabilities
and the smallest probability of a licence are found on notices and paragraphs that the fit did not see.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import text_or_empty
from shoplens.llm.decontaminate import text_key
from shoplens.session import durable

# Names of licences, and texts of common notices.
NAMES = {
    "agpl": ["GNU Affero General Public License", "AGPL", "AGPL-3.0", "GNU AGPL v3"],
    "apache": ["Apache License", "Apache License, Version 2.0", "Apache-2.0", "Apache 2.0 license"],
    "bsd": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "BSD-2-Clause"],
    "cc-by": ["CC BY 4.0", "CC BY", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0"],
    "cc-by-nc": ["CC BY-NC 4.0", "CC BY-NC", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0"],
    "cc-by-sa": ["CC BY-SA 4.0", "CC BY-SA", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"],
    "cc0": ["CC0", "CC0 1.0 Universal", "CC0-1.0", "Creative Commons Zero"],
    "gpl": ["GNU General Public License", "GNU General Public License, version 3", "GNU General Public License, version 2",
            "GPL", "GPLv3", "GPL-3.0", "GPL-2.0"],
    "isc": ["ISC License", "ISC"],
    "lgpl": ["GNU Lesser General Public License", "LGPL", "LGPL-2.1", "LGPL-3.0"],
    "mit": ["MIT License", "MIT", "MIT/X11 License"],
    "mpl": ["Mozilla Public License", "Mozilla Public License, v. 2.0", "MPL 2.0", "MPL-2.0"],
    "unlicense": ["Unlicense", "The Unlicense"],
}
FORMS = ["Licensed under the {}", "Licensed under {}", "Released under the {}", "Released under {}", "Distributed under the {}",
         "This work is licensed under the {}", "This work is licensed under a {}", "This software is released under the {}",
         "This program is free software licensed under the {}", "Available under the {}", "License: {}", "SPDX-License-Identifier: {}",
         "This project is licensed under the terms of the {}", "Published under the {}", "The code is licensed under {}"]
NOTICES = {
    "apache": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
               "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."],
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}
UNKNOWN = "unknown"
FAMILIES = [*sorted(NAMES), UNKNOWN]
# Lines of the corpus, those with the smallest hashes, taken for the class "unknown", and the characters of each that are; a
# word is telling if at most so large a share of them has it.
SAMPLE, SAMPLE_CHARS, TELLING_SHARE = 3000, 2000, 0.01
# The most probable families of a run of which the first that a template confirms is believed.
LIKELY = 3
# Words of a run, and of its step; no template has more words than what two runs share.
RUN, STEP = 96, 48
# Longest n-gram, share of false alarms allowed in calibration, share of a template's n-grams that confirms a prediction.
GRAM, FALSE_ALARMS, CONFIRMED = 3, 0.002, 0.75
BETWEEN = r"[^\p{L}\p{N}]+"


def words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def grams(w: list[str], telling: set[str]) -> set[str]:
    return {" ".join(w[k:k + n]) for n in range(1, GRAM + 1) for k in range(len(w) - n + 1) if telling & set(w[k:k + n])}


def templates() -> list[tuple[str, str]]:
    made = [(family, form.format(name)) for family, names in NAMES.items() for form in FORMS for name in names]
    return made + [(family, text) for family, texts in NOTICES.items() for text in texts]


class Model:
    """Weights by n-gram and family; `least` is the calibrated probability of any licence from which one is believed."""

    def __init__(self, sample: list[str]):
        rows = [(f, words(t)) for f, t in templates()]
        others = [words(t) for t in sample]
        known = {w for _, ws in rows for w in ws}
        seen = {}
        for ws in others:
            for w in set(ws) & known:
                seen[w] = seen.get(w, 0) + 1
        self.telling = {w for w in known if len(w) > 1 and seen.get(w, 0) <= TELLING_SHARE * len(others)}
        data = [(f, grams(w, self.telling)) for f, w in rows]
        # Notices also occur within other words.
        data += [(f, grams([*others[k % len(others)][:8], *w, *others[(k + 1) % len(others)][:8]], self.telling))
                 for k, (f, w) in enumerate(rows)] if others else []
        data += [(UNKNOWN, grams(w, self.telling)) for w in others]
        # Pieces of notices that name no licence are unknown too.
        data += [(UNKNOWN, grams(words(form.format("")), self.telling)) for form in FORMS for _ in range(4)]
        self.vocabulary = sorted(set().union(*(g for f, g in data if f != UNKNOWN)))
        column = {g: k for k, g in enumerate(self.vocabulary)}
        # Equal examples are one row that weighs more.
        times = Counter((f, frozenset(column[t] for t in g if t in column)) for f, g in data)
        x = np.zeros((len(times), len(self.vocabulary)), np.float32)
        for k, (_, g) in enumerate(times):
            x[k, list(g)] = 1
        self._fit(x, np.array([FAMILIES.index(f) for f, _ in times]), np.array(list(times.values())))

    def _fit(self, x: np.ndarray, y: np.ndarray, times: np.ndarray) -> None:
        held = np.arange(len(y)) % 5 == 0
        one = np.eye(len(FAMILIES), dtype=np.float32)[y]
        # Every family weighs alike.
        weight = times / np.bincount(y[~held], times[~held], len(FAMILIES)).clip(1)[y]
        weight = (weight * ~held / weight[~held].sum()).astype(np.float32)
        self.weights = np.zeros((x.shape[1], len(FAMILIES)), np.float32)
        self.bias = np.zeros(len(FAMILIES), np.float32)
        speed_w, speed_b, rate = 0.0, 0.0, 8.0
        for _ in range(150):
            wrong = (self.probabilities(x) - one) * weight[:, None]
            speed_w = 0.9 * speed_w - rate * (x.T @ wrong + 1e-5 * self.weights)
            speed_b = 0.9 * speed_b - rate * 0.1 * wrong.sum(axis=0)
            self.weights, self.bias = self.weights + speed_w, self.bias + speed_b
        self.weights[np.abs(self.weights) < 1e-3] = 0
        # Temperature of least log loss, then the probability that so few held-out unknown paragraphs exceed.
        logits = x[held] @ self.weights + self.bias
        loss = {t: -np.average(np.log(softmax(logits / t)[np.arange(held.sum()), y[held]].clip(1e-12)), weights=times[held]) for t in (0.5, 0.7, 1.0, 1.5, 2.0, 3.0, 5.0)}
        t = min(loss, key=loss.get)
        self.weights, self.bias = self.weights / t, self.bias / t
        p = 1 - self.probabilities(x[held])[:, -1]
        others = np.sort(np.repeat(p, times[held])[np.repeat(y[held], times[held]) == FAMILIES.index(UNKNOWN)])[::-1]
        # A template confirms what is believed, so nine tenths are enough whatever the sample holds.
        self.least = min(0.9, max(0.5, float(others[int(FALSE_ALARMS * len(others))]) if len(others) else 0.5))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(x @ self.weights + self.bias)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


# ---- scanning


def sample_paragraphs(docs: DataFrame) -> list[str]:
    """A bounded sample of lines by the hash of their texts, without those that speak of licences or rights."""
    texts = docs.select(text_or_empty().alias("text"))
    total = texts.agg(F.sum(F.size(F.split("text", "\n")).cast("long"))).first()[0] or 0
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).where(F.char_length("line") > 20)
    quiet = ~F.lower("line").rlike("licen[cs]|copyright|public domain|gpl|spdx|creative commons")
    share = min(1.0, 8 * SAMPLE / max(1, total))
    while True:
        # Only hashes below a bound are looked at, so that no task has more to tell than its part of the sample.
        bound = -(1 << 63) + int(share * ((1 << 64) - 1)) if share < 1 else (1 << 63) - 1
        found = lines.withColumn("h", F.xxhash64("line")).where((F.col("h") <= bound) & quiet).select("h", F.substring("line", 1, SAMPLE_CHARS).alias("line")) \
            .orderBy("h", "line").limit(SAMPLE).collect()
        if len(found) == SAMPLE or share == 1.0:
            return [r["line"] for r in found]
        share = min(1.0, 8 * share)


def _runs(size: int) -> Column:
    """All runs of `size` words of the column `w`."""
    n = F.size("w")
    runs = F.transform(F.sequence(F.lit(1), n - size + 1), lambda s: F.array_join(F.slice("w", s, size), " "))
    return F.when(n >= size, runs).otherwise(F.array().cast("array<string>"))


def paragraphs(text: Column) -> Column:
    """Runs of lines between lines without a word, each as one string."""
    trimmed = F.regexp_replace(text, r"(?m)^[\x20\x09-\x0D]+$", "")
    return F.filter(F.split(trimmed, r"\n(?:[\x20\x09-\x0D]*\n)+"), lambda p: F.btrim(p, F.lit(" \t\n\r\x0b\x0c")) != "")


def scan(docs: DataFrame) -> DataFrame:
    """(k1, k2, at, family, confidence): paragraphs of each distinct text and the licences whose notices they hold.

    k1, k2 are the hashes of the text, `at` the place of the paragraph from 0.
    """
    spark = docs.sparkSession
    model = Model(sample_paragraphs(docs))
    telling = F.array(*[F.lit(w) for w in sorted(model.telling)])
    texts = docs.select(text_or_empty().alias("text")).where(F.arrays_overlap(F.split(F.lower("text"), BETWEEN), telling))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("p") - (RUN - STEP) - 1), F.lit(STEP))
    runs = texts.select(*text_key("text"), F.posexplode(paragraphs(F.col("text"))).alias("at", "line")) \
        .withColumn("p", F.filter(F.split(F.lower("line"), BETWEEN), lambda w: w != "")).where(F.arrays_overlap("p", telling)) \
        .select("k1", "k2", "at", "p").dropDuplicates(["k1", "k2", "at"]) \
        .select("k1", "k2", "at", "p", F.explode(starts).alias("start")).withColumn("w", F.slice("p", F.col("start") + 1, RUN)) \
        .where(F.arrays_overlap("w", telling)).select("k1", "k2", "at", "start", "w")
    runs = durable(runs)
    told = F.array_distinct(F.concat(*[_runs(k) for k in range(1, GRAM + 1)]))
    unit = ["k1", "k2", "at", "start"]
    spoken = runs.select(*unit, F.explode(told).alias("gram"))
    # All tables have the size of the templates above, whatever the corpus.
    weights = spark.createDataFrame([(g, [float(v) for v in row]) for g, row in zip(model.vocabulary, model.weights)], "gram string, v array<double>")
    sums = [F.sum(F.get("v", F.lit(k))).alias(f"s{k}") for k in range(len(FAMILIES))]
    scored = spoken.join(F.broadcast(weights), "gram").groupBy(*unit).agg(*sums)
    logits = F.array(*[F.col(f"s{k}") + F.lit(float(model.bias[k])) for k in range(len(FAMILIES))])
    top = F.array_max("z")
    # The probability of any licence: a choice of two is none the less sure.
    licensed = 1 - F.exp(F.get("z", F.lit(len(FAMILIES) - 1)) - top) / F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    ranked = F.array_sort(F.transform(F.slice("z", 1, len(FAMILIES) - 1), lambda x, k: F.struct((-x).alias("z"), k.alias("k"))))
    guessed = scored.select(*unit, logits.alias("z")).select(*unit, "z", licensed.alias("confidence")).where(F.col("confidence") >= model.least) \
        .select(*unit, "confidence", F.posexplode(F.slice(ranked, 1, LIKELY)).alias("rank", "r")) \
        .select(*unit, "confidence", "rank", F.get(F.array(*map(F.lit, FAMILIES)), F.col("r.k")).alias("family"))
    guessed = durable(guessed)
    met = guessed.join(spoken, unit)
    shapes = [(k, f, grams(words(t), model.telling)) for k, (f, t) in enumerate(templates())]
    parts = spark.createDataFrame([(k, f, len(gs), g) for k, f, gs in shapes for g in sorted(gs)], "template int, family string, size int, gram string")
    confirmed = met.join(F.broadcast(parts), ["family", "gram"]) \
        .groupBy(*unit, "rank", "family", "confidence", "template").agg(F.count("*").alias("n"), F.first("size").alias("size")) \
        .where(F.col("n") >= CONFIRMED * F.col("size")) \
        .groupBy(*unit).agg(F.min_by(F.struct("family", "confidence"), "rank").alias("best")).select(*unit, "best.*")
    confirmed = durable(confirmed)
    own = {f: set().union(*(gs for _, g, gs in shapes if g == f)) for f in NAMES}
    names = [(k, first, f, g) for first in sorted(NAMES) for k, (f, name) in enumerate((f, n) for f in sorted(NAMES) for n in NAMES[f])
             if f != first and len(words(name)) > 1 for g in sorted(grams(words(name), model.telling) - own[first])]
    sizes = Counter((k, first) for k, first, _, _ in names)
    others = spark.createDataFrame([(k, first, f, g, sizes[k, first]) for k, first, f, g in names], "name int, family string, other string, gram string, size int")
    further = confirmed.join(spoken, unit).join(F.broadcast(others), ["family", "gram"]) \
        .groupBy(*unit, "confidence", "other", "name").agg(F.count("*").alias("n"), F.first("size").alias("size")).where("n = size") \
        .select("k1", "k2", "at", F.col("other").alias("family"), "confidence")
    return confirmed.select("k1", "k2", "at", "family", "confidence").unionByName(further) \
        .groupBy("k1", "k2", "at", "family").agg(F.max("confidence").alias("confidence"))


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_paragraphs, n_licensed (those with a licence), families (sorted, comma-joined), confidence.

    A null text has no paragraphs; families is empty and confidence 0 where nothing was found. A null doc_id stays null,
    repeated rows give repeated results, an empty table none; other columns are not looked at.
    """
    found = durable(scan(docs)).groupBy("k1", "k2").agg(
        F.count_distinct("at").alias("n"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("f"), F.max("confidence").alias("c"))
    text = text_or_empty()
    rows = docs.select("doc_id", *text_key(text), F.size(paragraphs(text)).cast("long").alias("n_paragraphs"))
    return rows.join(found, ["k1", "k2"], "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n", F.lit(0)).alias("n_licensed"), F.coalesce("f", F.lit("")).alias("families"),
        F.round(F.coalesce("c", F.lit(0.0)), 6).alias("confidence"))
