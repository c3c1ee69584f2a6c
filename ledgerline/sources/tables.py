"""Where tables come from."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class ParquetTables:
    """Tables below one folder: ``tables["orders"]`` reads ``<root>/orders.parquet``.

    Files are listed and a footer is read once per table, however often a plan uses it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._open: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return posixpath.join(self.root, f"{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(self.path(name))
        return self._open[name]


def inline(spark: SparkSession, schema: str, *rows: tuple) -> DataFrame:
    """``(VALUES ..) AS t(cols)``; one row makes a row of constants."""
    return spark.createDataFrame(list(rows), schema)


def sequence_rows(spark: SparkSession, first: int, last: int, name: str = "x") -> DataFrame:
    """``generate_series(first, last)``, made in the tasks."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def labelled_rows(spark: SparkSession, n: int, prefix: str, name: str = "col") -> DataFrame:
    """``prefix || x`` for x = 1..n."""
    return sequence_rows(spark, 1, n).select(F.concat(F.lit(prefix), F.col("x").cast("string")).alias(name))


def array_rows(df: DataFrame, array: Column, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """``unnest(array)``."""
    return df.select(*keep, F.explode(array).alias(name))
