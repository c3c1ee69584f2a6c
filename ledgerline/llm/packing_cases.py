"""Query for packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import packing
from ledgerline.llm.text_cases import documents


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 tokens."""
    return packing.tokenize_and_pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op8_packing": packed}
ORACLE: dict[str, str] = {}
