"""Joins that look something up: latest row, surrogate key, membership."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_value(value: str, when: str, tie_break: str) -> Column:
    """Aggregate: ``value`` of the row with the greatest ``(when, tie_break)``."""
    return F.max_by(value, F.struct(when, tie_break))


def surrogate_keys(dimension: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """Natural key to one surrogate key; the smallest if a natural key repeats."""
    return thin(dimension, natural, F.min(key).alias(key))


def thin(df: DataFrame, on: Sequence[str], *figures: Column) -> DataFrame:
    """One row per key, with aggregates, in a form whose join can split a hot key on the other side.

    AQE splits a join side only when both sides are plain shuffles. After ``distinct`` or ``groupBy`` on
    the join key the join would take over their shuffle, aggregate and all. Grouping by the key as one
    struct gives the same rows in a layout that the join cannot take over: it shuffles the keys, by then one
    row each, once more.
    """
    grouped = df.groupBy(F.struct(*on).alias("__key"))
    counted = grouped.agg(*figures) if figures else grouped.agg(F.lit(1).alias("__one"))
    return counted.select(*[F.col(f"__key.{k}").alias(k) for k in on], *_names(figures, df))


def _names(figures: Sequence[Column], df: DataFrame) -> list[str]:
    return df.limit(0).agg(*figures).columns if figures else []


def resolve_key(
    facts: DataFrame, dimension: DataFrame, on: Mapping[str, str], key: str, name: str | None = None
) -> DataFrame:
    """Left join by natural key; an unknown one leaves the surrogate key NULL.

    ``on`` maps fact columns to dimension columns. Spark broadcasts the dimension
    when its size allows; otherwise AQE splits a hot key on the fact side.
    """
    known = surrogate_keys(dimension, list(on.values()), key)
    right = known.select(
        *[F.col(d).alias(f"__d_{i}") for i, d in enumerate(on.values())], F.col(key).alias(name or key)
    )
    same = F.lit(True)
    for i, f in enumerate(on):
        same = same & (F.col(f) == F.col(f"__d_{i}"))
    return facts.join(right, same, "left").drop(*[f"__d_{i}" for i in range(len(on))])


def _keys(other: DataFrame, on: Sequence[str], unique: bool) -> DataFrame:
    """The join keys of the right side, each once.

    In a semi or anti join AQE can split a hot key only on the left, so on the right it is made one row.
    """
    keys = other.select(*on)
    return keys if unique else thin(keys, on)


def present(df: DataFrame, other: DataFrame, on: Sequence[str], unique: bool = False) -> DataFrame:
    """``EXISTS`` / ``IN (subquery)``. ``unique`` says that ``other`` holds each key once."""
    return df.join(_keys(other, on, unique), list(on), "left_semi").select(*df.columns)


def absent(df: DataFrame, other: DataFrame, on: Sequence[str], unique: bool = False) -> DataFrame:
    """``NOT EXISTS``: rows without a partner, rows with a NULL key among them."""
    return df.join(_keys(other, on, unique), list(on), "left_anti").select(*df.columns)


def left_join_many(df: DataFrame, many: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left outer join with a side that may repeat a key without limit.

    A left outer join cannot be split on its right side. The matches are an inner
    join, which can, and the rows without any are added by an anti join.
    """
    matched = df.join(many, list(on), "inner")
    return matched.unionByName(absent(df, many, on), allowMissingColumns=True)


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """SQL ``NOT IN (subquery)`` with its rules for NULL, at any size.

    Written as ``NOT IN``, a list too large to broadcast turns into a nested loop.
    Here the equi anti join is a hash or merge join, and two figures about the list
    decide the rest: an empty list keeps every row, a NULL in the list keeps none,
    and a NULL on the left is kept only by an empty list.
    """
    listed = other.select(F.col(other_column).alias("__listed"))
    figures = listed.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("__listed").isNull(), 1)).alias("nulls")).alias("f")
    ).scalar()
    kept = df.join(thin(listed, ["__listed"]), F.col(column) == F.col("__listed"), "left_anti")
    return kept.filter((figures["n"] == 0) | ((figures["nulls"] == 0) & F.col(column).isNotNull()))


def in_pairs(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple]) -> DataFrame:
    """Row-value ``IN`` as a semi join on the literal list, which Spark broadcasts by its known size."""
    listed = [tuple(p) for p in dict.fromkeys(pairs)]
    return df.join(df.sparkSession.createDataFrame(listed, df.select(*columns).schema), list(columns), "left_semi")


def only_value(df: DataFrame, column: str) -> Column:
    """Scalar subquery: the one value of ``df``. NULL when there is no row, an error when there are two."""
    return df.select(column).scalar()
