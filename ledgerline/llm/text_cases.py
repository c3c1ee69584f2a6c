"""Queries over whole texts: quality rules and token counts."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import quality_ledger, token_counts
from ledgerline.llm.scratch import new_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows of all documents and the verdict of the standard policy."""
    ledger = quality_ledger.build_ledger(documents(spark, sf_dir).select("doc_id", "text"))
    return ledger.select(
        "doc_id",
        *quality_ledger.MEASURES[:5],
        (~quality_ledger.accepted(quality_ledger.BASE)).alias("base_failed"),
        quality_ledger.accepted(quality_ledger.STANDARD).alias("kept"),
        "failed",
    )


QUALITY_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
windows AS (
  SELECT doc_id, i, w[i:i+4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY doc_id
),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
echoes AS (
  SELECT doc_id, count(*) AS n FROM (SELECT doc_id, w, unnest(range(2, len(w) + 1)) AS i FROM words)
  WHERE w[i] = w[i - 1] GROUP BY doc_id
),
filled AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
m AS (
  SELECT w.doc_id, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(w.text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(f.n_dup, 0)::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(f.n_lines, 0)::BIGINT AS n_lines,
    coalesce(e.n, 0)::BIGINT AS n_echo
  FROM words w LEFT JOIN echoes e ON e.doc_id = w.doc_id LEFT JOIN covered c ON c.doc_id = w.doc_id LEFT JOIN filled f ON f.doc_id = w.doc_id
),
b AS (
  SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
    + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (n_lines > 0 AND 2 * n_dup_lines > n_lines)::BIGINT
    + 16 * (n_words > 0 AND word_chars < 2 * n_words)::BIGINT + 32 * (n_words > 0 AND word_chars > 20 * n_words)::BIGINT
    + 64 * (10 * n_echo > 3 * n_words)::BIGINT AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed
FROM b
"""


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of one tokenizer for all documents, through a cache of this call."""
    counts = token_counts.count_tokens(
        documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), new_path(spark, "token-cache")
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


QUERIES = {"op9_quality_rules": quality_rules, "op10_token_counts": token_count}
ORACLE = {"op9_quality_rules": QUALITY_SQL}
