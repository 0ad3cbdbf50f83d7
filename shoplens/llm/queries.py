"""The registered queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import bpe, decontaminate, fim, htmltext, langid, licenses, linededup, lm, packing, phrases, quality, simhash, tokenstore
from shoplens.llm.common import prepare
from shoplens.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_byte_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = bpe.Bpe(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(codec, table(spark, sf_dir, "documents"))


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


@query("op9_token_store")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenstore.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return tokenstore.documents(spark, path)


@query("op2_line_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.counted(table(spark, sf_dir, "documents"))


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op10_decontamination", sql=f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS_SQL} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(list_slice(w, p, p + 9), ' ') AS win
        FROM b, unnest(generate_series(1, greatest(1, len(w) - 9))) AS t(p) WHERE len(w) > 0),
spot AS (SELECT r, p, size, array_to_string(list_slice(w, p, p + size - 1), ' ') AS win
         FROM d, (SELECT DISTINCT size FROM win), unnest(generate_series(1, len(w) - size + 1)) AS t(p)),
met AS (SELECT r, p, spot.size, item FROM spot JOIN win USING (win)),
covered AS (SELECT r, count(DISTINCT q) AS n_hit FROM met, unnest(generate_series(p, p + size - 1)) AS t(q) GROUP BY r),
named AS (SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM met) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no address: their source stands for the host."""
    docs = table(spark, sf_dir, "documents").withColumnRenamed("lang", "lang_declared")
    return langid.identify(docs, F.col("lang_declared"), F.col("source"), F.lit(""), ["doc_id", "lang_declared"])


@query("page_language_id")
def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the language of their markup, the suffix of their address and their host."""
    pages = table(spark, sf_dir, "pages")
    host = F.lower(F.regexp_extract("url", "^[a-zA-Z]+://([^/:?#]*)", 1))
    declared = F.regexp_extract("html", "(?i)<html[^>]*?\\slang=[\"']?([a-z]{2,3})", 1)
    text = F.regexp_replace(F.regexp_replace("html", "(?is)<(script|style)\\b.*?</\\1>", " "), "<[^>]*>", " ")
    return langid.identify(pages.withColumn("text", text), declared, host, F.regexp_extract(host, "([^.]*)$", 1), ["page_id", "url"])


@query("op3_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


@query("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


@query("op8_lm_scores")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


LOW_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_phrases", sql=rf"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOW_SQL}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
f AS (SELECT lang, size, phrase, count(*) AS f FROM (
        SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase
        FROM (SELECT lang, w, unnest([1, 2, 3, 4]) AS size FROM w), unnest(generate_series(1, len(w) - size + 1)) AS t(i))
      GROUP BY ALL HAVING count(*) >= 30),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
cut AS (SELECT lang, size, phrase, f AS a, k, array_to_string(list_slice(s, 1, k), ' ') AS one, array_to_string(list_slice(s, k + 1, size), ' ') AS rest
        FROM (SELECT *, string_split(phrase, ' ') AS s FROM f WHERE size > 1), unnest(generate_series(1, size - 1)) AS t(k)),
scored AS (SELECT cut.*, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS BIGINT) AS score
           FROM cut JOIN f AS x ON x.lang = cut.lang AND x.phrase = one JOIN f AS y ON y.lang = cut.lang AND y.phrase = rest),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, array_to_string(list_slice(s, i, i + m - 1), ' ') AS phrase, max(f) AS longer
           FROM (SELECT lang, f, size, string_split(phrase, ' ') AS s, unnest(generate_series(2, size - 1)) AS m FROM f WHERE size > 2),
             unnest(generate_series(1, size - m + 1)) AS t(i) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest LEFT JOIN longer USING (lang, phrase) JOIN total USING (lang)
WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < 80 * a
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op12_fill_in_middle", sql=r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
             sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS UBIGINT) AS h1, CAST('0x' || h[9:16] AS UBIGINT) AS h2,
        CAST('0x' || h[17:24] AS UBIGINT) AS h3, CAST('0x' || h[25:32] AS UBIGINT) AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS one, greatest(h1 % (n + 1), h2 % (n + 1)) AS two,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
             WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c),
p AS (SELECT *, array_to_string(u[1:one], '') AS prefix, array_to_string(u[one + 1:two], '') AS middle,
        array_to_string(u[two + 1:n], '') AS suffix FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


@query("op13_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
