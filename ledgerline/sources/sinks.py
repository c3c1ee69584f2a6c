"""Where results go: create, append, replace partitions, empty, drop.

A job that rewrites a table reads the old snapshot while it writes, so
``publish_snapshot`` writes a folder that nothing else has, and then a marker that
names it. Readers follow the last marker; what a failed write left is never read.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def create_table_as(df: DataFrame, name: str, path: str | None = None) -> None:
    """``CREATE TABLE AS``; fails if the table exists."""
    writer = df.write.mode("errorifexists").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_new(df: DataFrame, path: str) -> None:
    """CTAS to a folder; fails if it exists."""
    df.write.mode("errorifexists").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Append; each row lands in its partition folder. Rows of one partition are brought
    together by AQE's rebalance, which also splits a partition that is too large for one file."""
    df.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def truncate_path(spark: SparkSession, path: str) -> None:
    """Empty a parquet folder, keeping its schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_view(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {name}")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """A stored query, evaluated when read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, whichever it is, and the path for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    fs, target = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it."""
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def _markers(root: str) -> str:
    return f"{root}/_published"


def snapshot_path(spark: SparkSession, root: str) -> str | None:
    """Folder of the snapshot that was published last, of the highest version."""
    names = folder_names(spark, _markers(root))
    return f"{root}/{names[-1]}" if names else None


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The table as last published."""
    path = snapshot_path(spark, root)
    if path is None:
        raise FileNotFoundError(f"no snapshot was published below {root}")
    return spark.read.parquet(path)


def publish_snapshot(df: DataFrame, root: str, version: int) -> DataFrame:
    """Write one version of a table beside all earlier ones and make it the current one.

    Nothing that exists is overwritten, so ``df`` may read any earlier snapshot, that of the same version
    too. A job that is run again publishes the version anew; its last result counts.
    """
    spark = df.sparkSession
    name = f"version={version:012d}-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(f"{root}/{name}")
    fs, marker = _hadoop(spark, f"{_markers(root)}/{name}")
    fs.create(marker, False).close()
    return spark.read.schema(df.schema).parquet(f"{root}/{name}")
