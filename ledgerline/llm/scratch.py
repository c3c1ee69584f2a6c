"""Intermediate tables in the shared checkpoint folder.

A table is written once, so a lost executor cannot bring other values and later branches do not compute it
anew; steps of an iteration drop the tables that they have replaced.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import ensure_checkpoint_dir


def new_path(spark: SparkSession, name: str) -> str:
    """A folder name below the checkpoint folder that nothing else uses."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, **options) -> DataFrame:
    """Write ``df`` to ``path`` and read it from there; options are those of Spark's writer."""
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str = "step", **options) -> DataFrame:
    """``df`` as a table of its own below the checkpoint folder."""
    return write_table(df, new_path(df.sparkSession, name), **options)


def stored_in_parts(parts: Iterable[DataFrame], name: str = "step", **options) -> DataFrame:
    """The rows of all parts, one or more, as one table; they are made one after the other, and the shuffle files of each go before the next."""
    table = path = None
    for df in parts:
        path = path or new_path(df.sparkSession, name)
        df.write.mode("append").options(**options).parquet(path)
        release(df.sparkSession)
        table = df
    return table.sparkSession.read.schema(table.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove a table of ``stored`` that nothing reads any more."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        drop_path(df.sparkSession, folder)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever file system its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps, which otherwise wait for the driver to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()
