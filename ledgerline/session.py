"""Session settings for tests and benchmarks, and the checkpoint folder rule."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "ledgerline", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables.

    The cluster names a shared one in ``spark.checkpoint.dir``. Only a local
    master, where every task sees the same disk, may fall back to a temporary one.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can read")
        configured = tempfile.mkdtemp(prefix="ledgerline-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


#: Folders that ``cut_lineage`` wrote in this process.
_WRITTEN: list[str] = []


def drop_intermediate(spark: SparkSession) -> int:
    """Remove the tables that ``cut_lineage`` wrote so far; nothing may read them any more. Returns how many."""
    hadoop = spark._jsc.hadoopConfiguration()
    done = 0
    while _WRITTEN:
        target = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        done += bool(target.getFileSystem(hadoop).delete(target, True))
    return done


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to a table below the checkpoint folder and read it from there.

    Later branches do not compute it anew, and a lost executor cannot bring other
    values. A parquet table rather than ``checkpoint()``: it is smaller, and each
    reader takes only the columns it needs. The table stays until ``drop_intermediate``
    or until the folder is cleaned.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/ledgerline-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
