"""Query for benchmark decontamination."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontamination
from ledgerline.llm.text_cases import documents


def decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, whether it holds a benchmark item, how many, and the best one."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    benchmark = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    found = decontamination.contaminated(docs, benchmark)
    best = F.max(F.struct("score", -F.col("item_id")))
    held = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_items"), best.alias("b"))
    held = held.select(F.col("doc_id").alias("d"), "n_items", (-F.col("b.col2")).alias("best_item"), F.col("b.score").alias("best_score"))
    return docs.select("doc_id").join(held, F.col("doc_id") == F.col("d"), "left").select(
        "doc_id",
        F.col("d").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "best_item",
        "best_score",
    )


QUERIES = {"op7_decontamination": decontaminated}
ORACLE: dict[str, str] = {}
