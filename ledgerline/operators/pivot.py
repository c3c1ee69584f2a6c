"""Pivots with a fixed list of values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numbers import TOTAL


def crosstab(df: DataFrame, rows: Sequence[str], category: str, cells: Mapping[object, str], value: Column) -> DataFrame:
    """One column per listed category; an absent cell is NULL, an unlisted category is dropped.

    The list is given, so no job runs to find it, and both phases of the aggregate
    are hash aggregates: the input needs no order.
    """
    wide = df.groupBy(*rows).pivot(category, list(cells)).agg(value)
    return wide.select(*rows, *[F.col(f"`{key}`").alias(name) for key, name in cells.items()])


def sum_if(condition: Column, value: Column) -> Column:
    """``SUM(CASE WHEN condition THEN value ELSE 0 END)``: an absent cell is 0."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def conditional_sums(
    df: DataFrame, rows: Sequence[str], category: str, cells: Mapping[object, str], value: Column
) -> DataFrame:
    """Pivot by conditional sums; an absent cell is 0."""
    return df.groupBy(*rows).agg(
        *[sum_if(F.col(category) == key, value).cast(TOTAL).alias(name) for key, name in cells.items()]
    )


def conditional_counts(df: DataFrame, rows: Sequence[str], category: str, cells: Mapping[str, str]) -> DataFrame:
    """Pivot by conditional counts; the comparison is case-sensitive."""
    return df.groupBy(*rows).agg(
        *[sum_if(F.col(category) == key, F.lit(1)).cast("bigint").alias(name) for key, name in cells.items()]
    )
