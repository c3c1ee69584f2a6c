"""Registered queries: a Spark function and, where one exists, the same query as plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.tables import ParquetTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def case(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name`` with its SQL twin."""

    def register(fn: Callable[[ParquetTables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ParquetTables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def shown(df: DataFrame) -> DataFrame:
    """Plain output types that every engine agrees on: exact decimals as double, dates as ISO text."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        c = F.col(f"`{field.name}`")
        if kind.startswith("decimal"):
            c = c.cast("double")
        elif kind in ("date", "timestamp_ntz", "timestamp"):
            c = F.date_format(c, "yyyy-MM-dd")
        columns.append(c.alias(field.name))
    return df.select(*columns)
