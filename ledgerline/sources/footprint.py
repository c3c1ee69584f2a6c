"""Storage report: bytes, files and rows per table, from a listing of its files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import size_text


def footprint(tables: Mapping[str, DataFrame], name_like: str = "%") -> DataFrame:
    """One row per table whose name matches.

    Files and bytes come from listing the files, whose content is not read, so files without rows count
    too; rows come from a plain count, which reads no column.
    """
    parts = []
    for name, df in tables.items():
        spark = df.sparkSession
        files = df.inputFiles()
        if files:
            roots = sorted({f.rpartition("/")[0] for f in files}) if len(files) > 1 else files
            listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(roots).select("path", "length")
            sizes = listed.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))
        else:
            sizes = spark.range(1).select(F.lit(0).cast("bigint").alias("n_files"), F.lit(0).cast("bigint").alias("total_bytes"))
        rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
        parts.append(
            sizes.withColumn("n_rows", rows.scalar()).select(F.lit(name).alias("table_name"), "n_files", "n_rows", "total_bytes")
        )
    report = reduce(lambda a, b: a.unionByName(b), parts)
    return report.filter(F.col("table_name").like(name_like)).withColumn("total", size_text(F.col("total_bytes")))
