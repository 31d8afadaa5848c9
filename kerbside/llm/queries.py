"""Registered queries of the pipeline's operators over the tables of a data directory, with their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.llm import (
    byte_bpe, chat_quotes, collocations, decontaminate, importance, license_scan, ngram_join, personal_data, quality, sharding, sql,
    substring_dedup, token_counts, warc,
)
from kerbside.operators.staging import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), model)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_quotes.conversations(table(spark, sf_dir, "conversations"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.digests(byte_bpe.encode_documents(table(spark, sf_dir, "documents"), ranks, pattern, decode=True))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "doc_id", SHARDS)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_digests(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("quality", 6).alias("quality"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.span_digests(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_token_counts, op2_ngram_jaccard_join, op3_chat_formatting, op4_license_scan,
            op5_benchmark_decontamination, op6_byte_bpe, op7_warc, op8_sharding,
            op9_substring_dedup, op10_quality_rules, op11_collocations, op12_personal_data,
            op13_importance_resampling,
        )
    }


#: Windows of words as lists, so for tables of some thousand documents.
_COLLOCATIONS = r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
      FROM documents),
    listed AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM listed GROUP BY 1),
    starts AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM listed, (VALUES (1), (2), (3), (4)) sizes(k)),
    grams AS (
      SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM starts
      GROUP BY 1, 2, 3 HAVING count(*) >= 30),
    split AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE k > 1),
    cuts AS (SELECT *, unnest(range(1, k)) AS j FROM split),
    scored AS (
      SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, c.j, (2000000 * c.f::HUGEINT) // (x.f + y.f) AS score
      FROM cuts c
      JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.j], ' ')
      JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.j + 1:], ' ')),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    inside AS (
      SELECT lang, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:], ' ')]) AS phrase, f FROM split WHERE k > 2),
    longest AS (SELECT lang, phrase, max(f) AS f FROM inside GROUP BY 1, 2)
    SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n,
           CAST(score AS BIGINT) AS score
    FROM best b JOIN totals USING (lang) LEFT JOIN longest g ON g.lang = b.lang AND g.phrase = b.phrase
    WHERE g.f IS NULL OR 100 * g.f < 80 * a
    QUALIFY rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_ngram_jaccard_join": sql.NEAR_DUPLICATES, "op7_warc": sql.WARC, "op9_substring_dedup": sql.SUBSTRING_DEDUP,
        "op11_collocations": _COLLOCATIONS, "op13_importance_resampling": sql.IMPORTANCE,
    }
