"""From raw documents to token ids: the stages in their order, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import bpe, decontaminate, langid, linededup, simhash
from shoplens.llm.common import prepare
from shoplens.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; `lang` is the declaration, `source` stands for the host."""
    prepare(spark)
    return langid.accepted(docs, F.col("lang"), F.col("source"), F.lit(""))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document or line has; n_chars follows the text."""
    prepare(spark)
    return linededup.dedup_lines(docs, min_equal=linededup.MIN_EQUAL).withColumn("n_chars", F.char_length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints over three-word shingles link at two bits or fewer."""
    prepare(spark)
    return simhash.one_of_each(docs, words=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    prepare(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: its columns but text and n_chars, its packed little-endian 32-bit ids, their number, and digests of them and of
    what they decode to. A null text has no ids; rows that are equal stay so."""
    prepare(spark)
    codec = bpe.Bpe(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = codec.encode_and_decode(docs)
    return coded.withColumn("n_tokens", F.shiftright(F.length("ids"), 2).cast("long")).withColumn("ids_sha256", F.sha2("ids", 256)) \
        .withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("text", "n_chars", "decoded")


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("byte_bpe", byte_bpe)]

# Learned language models, groups of linked fingerprints and tokens are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written as Parquet in the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
