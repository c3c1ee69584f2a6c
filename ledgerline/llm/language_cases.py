"""Query for language identification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import language_id
from ledgerline.llm.text_cases import documents


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; those held out teach nothing."""
    docs = documents(spark, sf_dir).withColumn("held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.learn(docs.filter(~F.col("held_out")))
    return language_id.label(docs.select("doc_id", "held_out", "text"), model)


QUERIES = {"op13_language_id": languages}
ORACLE: dict[str, str] = {}
