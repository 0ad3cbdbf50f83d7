"""The pipeline against its stages done one after the other in plain Python, on the smallest given table."""

import hashlib

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from test_llm_operators import SF, plain_hits, reference_encoding
from test_whole_job import plain_whole_dedup

from shoplens.llm import decontaminate, simhash


def one_of_each(rows):
    """Smallest doc_id of each group of texts whose fingerprints link at two bits or fewer."""
    prints = [int.from_bytes(simhash.fingerprint(t or "", 3)) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        least[find(k)] = min(doc, least.get(find(k), doc))
    return set(least.values())


def test_one_of_each(spark):
    """Copies, near copies, repeated rows, null ids, texts without words, clashing columns."""
    base = " ".join(f"word{k}" for k in range(300))
    rows = [(5, base), (3, base), (None, base), (3, base), (9, base.replace("word7 ", "other ")), (8, ""), (None, None), (7, "  "), (7, "  "),
            (1, "a text of its own"), (None, "another text of its own, without id"), (None, "another text of its own, without id")]
    made = spark.createDataFrame([(k, t, 1, 2, 3) for k, t in rows], "doc_id long, text string, _tie int, fp int, root int").repartition(3)
    got = [tuple(r)[:2] for r in simhash.one_of_each(made).collect()]
    near = (simhash.fingerprint(base, 3), simhash.fingerprint(rows[4][1], 3))
    linked = (int.from_bytes(near[0]) ^ int.from_bytes(near[1])).bit_count() <= 2
    want = [(3, base), (7, "  "), (1, rows[9][1]), (None, rows[10][1])] + ([] if linked else [rows[4]])
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simhash.one_of_each(made).columns == made.columns
    assert simhash.one_of_each(made.where("false")).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    # All of these documents are in a language.
    keyed = [tuple(r) for r in docs.select("doc_id", "text", *decontaminate.text_key(F.coalesce("text", F.lit("")))).collect()]
    cut = plain_whole_dedup(keyed)
    rows = [(k, cut[k, t]) for k, t, _, _ in keyed]
    alone = one_of_each(rows)
    rows = [r for r in rows if r[0] in alone]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {r[0] for r in plain_hits(rows, items) if r[5]}
    encoding, want = reference_encoding(), {}
    for key, text in rows:
        if key not in hit:
            ids = np.array(encoding.encode_ordinary(text), "<u4")
            want[key] = (len(ids), ids.tobytes(), hashlib.sha256(text.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], bytes(r["ids"]), r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), SF).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), SF).count() == 0
