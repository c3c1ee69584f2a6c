"""Query for toxicity."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import toxicity
from ledgerline.llm.text_cases import documents


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model that learned from the rows that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.fit(docs, labels, ~held_out)
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.DECISION).cast("int").alias("predicted"),
        "flagged",
    )


QUERIES = {"op4_toxicity": toxicity_scores}
ORACLE: dict[str, str] = {}
