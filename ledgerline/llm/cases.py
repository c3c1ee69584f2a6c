"""The registered queries of this subpackage and, where SQL can express them, the same as SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.shipping import ship

#: Modules with ``QUERIES`` (name to function of a session and a folder of tables) and ``ORACLE`` (name to SQL).
MODULES = ("text_cases", "near_cases", "packing_cases", "warc_cases", "decontamination_cases", "line_cases", "toxicity_cases", "license_cases", "suffix_cases", "merkle_cases", "language_cases", "lexical_cases")


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    oracle: dict[str, str] = {}
    for name in MODULES:
        module = importlib.import_module(f"ledgerline.llm.{name}")
        queries.update(module.QUERIES)
        oracle.update(module.ORACLE)
    pipeline = importlib.import_module("corpus_pipeline")
    queries["pipeline"] = pipeline.run
    if pipeline.ORACLE_SQL:
        oracle["pipeline"] = pipeline.ORACLE_SQL
    return {name: _shipped(fn) for name, fn in queries.items()}, oracle


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with the package sent to the tasks before."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run
