"""Queries for near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import simhash
from ledgerline.llm.text_cases import documents


def simhash_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: three words, at most two differing bits."""
    groups = simhash.near_duplicates(documents(spark, sf_dir), max_bits=2, words=3)
    return groups.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


QUERIES = {"op3_simhash_near": simhash_near}
ORACLE: dict[str, str] = {}
