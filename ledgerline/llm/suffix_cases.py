"""Query for the removal of repeated passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import suffix_dedup
from ledgerline.llm.text_cases import documents


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, what strings of 400 bytes that also start elsewhere take away, and the digest of what stays."""
    rows = suffix_dedup.remove_repeats(documents(spark, sf_dir), length=400)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op6_repeated_passages": repeated_passages}
ORACLE: dict[str, str] = {}
