"""Sort order and top-k. Null placement is always named, ties always have a last key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ascending(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def descending(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_first() for n in names]


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """``ORDER BY ... LIMIT k``; Spark keeps k rows per task before the merge."""
    return df.orderBy(*order).limit(k)


def top_n_per_group(
    df: DataFrame, group: Sequence[Column | str], order: Sequence[Column], n: int, rank_name: str = "rn"
) -> DataFrame:
    """The first ``n`` rows of each group.

    The filter on ``row_number`` lets Spark drop rows beyond ``n`` on the map side,
    so even a group that holds most of the table sends ``n`` rows per task.
    """
    window = W.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(window)).filter(F.col(rank_name) <= n)


def top_rank_per_group(
    df: DataFrame, group: Sequence[Column | str], order: Sequence[Column], n: int, rank_name: str = "rk"
) -> DataFrame:
    """Rows of rank ``n`` or better; all rows of a tie stay."""
    window = W.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_name, F.rank().over(window)).filter(F.col(rank_name) <= n)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``."""
    return top_n_per_group(df, list(key), order, 1, "__first").drop("__first")


def random_pick(df: DataFrame, seed: int, key: Sequence[str] | None = None) -> DataFrame:
    """One row at random, each with the same chance; the same one for the same seed, however the rows lie.

    Every row has a priority, a digest of the seed and its ``key`` (all columns, unless it is given), and the least one is
    taken: one pass in which each task keeps one row, without a sort. Rows that share the key share the chance.
    """
    columns = [F.col(f"`{c}`") for c in (key or df.columns)]
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    picked = df.agg(F.min_by(row, F.struct(F.md5(text), row)).alias("r")).filter(F.col("r").isNotNull())
    return picked.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(df.columns)])
