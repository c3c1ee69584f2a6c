"""Integrity rules as distributed checks.

Each rule becomes violation rows ``(table_name, rule, key, reason, n_rows)``. All
row rules of a table share one scan. Key rules aggregate before they shuffle, so
a value that fills a third of a table is one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VIOLATIONS = "table_name string, rule string, key string, reason string, n_rows bigint"


@dataclass(frozen=True)
class RowRule:
    """A rule that one row alone can break. ``broken`` NULL means it holds, as in CHECK."""

    rule: str
    broken: Column
    reason: str


def not_null(column: str) -> RowRule:
    return RowRule("not_null", F.col(column).isNull(), f"{column} is null")


def check(name: str, holds: Column) -> RowRule:
    return RowRule("check", ~holds, name)


def one_of(column: str, values: Sequence) -> RowRule:
    return RowRule("domain", ~F.col(column).isin(list(values)), f"{column} not in list")


def max_length(column: str, length: int) -> RowRule:
    return RowRule("length", F.length(column) > length, f"{column} longer than {length}")


def fits_decimal(column: str, precision: int, scale: int) -> RowRule:
    """Breaks where the value has too many integer digits or is no number.

    More decimals than ``scale`` are rounded, as on insert. The value is widened and
    compared: a cast that fails costs an exception per row.
    """
    wide = F.col(column).try_cast(f"decimal(38,{scale})")
    too_long = F.abs(wide) >= F.lit(10 ** (precision - scale))
    broken = F.col(column).isNotNull() & (wide.isNull() | too_long)
    return RowRule("precision", broken, f"{column} exceeds decimal({precision},{scale})")


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableRules:
    key: tuple[str, ...]
    rows: tuple[RowRule, ...] = ()
    unique: tuple[Unique, ...] = ()
    foreign: tuple[ForeignKey, ...] = ()
    primary: bool = True
    types: Mapping[str, str] = field(default_factory=dict)


def _key_text(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])


def row_violations(name: str, df: DataFrame, key: Sequence[str], rules: Sequence[RowRule]) -> DataFrame:
    """All row rules in one pass over the table."""
    found = [
        F.when(r.broken, F.struct(F.lit(r.rule).alias("rule"), F.lit(r.reason).alias("reason"))) for r in rules
    ]
    hits = df.select(_key_text(key).alias("key"), F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("v"))
    return hits.select(
        F.lit(name).alias("table_name"),
        F.col("v.rule").alias("rule"),
        "key",
        F.col("v.reason").alias("reason"),
        F.lit(1).cast("bigint").alias("n_rows"),
    )


def unique_violations(name: str, df: DataFrame, columns: Sequence[str], rule: str = "unique") -> DataFrame:
    """Keys that occur more than once; a key with a NULL part never conflicts."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    counts = df.filter(complete).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
    return counts.select(
        F.lit(name).alias("table_name"),
        F.lit(rule).alias("rule"),
        _key_text(columns).alias("key"),
        F.lit("duplicate " + ", ".join(columns)).alias("reason"),
        "n_rows",
    )


def primary_key_violations(name: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Duplicates, and rows whose key has a NULL part."""
    missing = row_violations(
        name, df, columns, [RowRule("primary_key", F.col(c).isNull(), f"{c} is null") for c in columns]
    )
    return unique_violations(name, df, columns, "primary_key").unionByName(missing)


def foreign_key_violations(
    name: str, df: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str], parent_name: str
) -> DataFrame:
    """Key values without a parent, with the number of rows that carry each; a NULL part passes."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    used = df.filter(complete).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_columns, columns)])
    return used.join(known, list(columns), "left_anti").select(
        F.lit(name).alias("table_name"),
        F.lit("foreign_key").alias("rule"),
        _key_text(columns).alias("key"),
        F.lit(f"no {parent_name} row for " + ", ".join(columns)).alias("reason"),
        "n_rows",
    )


def violations(spark: SparkSession, tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> DataFrame:
    """Every violation of every declared rule of a model."""
    parts = [spark.createDataFrame([], VIOLATIONS)]
    for name, rule in rules.items():
        if name not in tables:
            continue
        df = tables[name]
        if rule.rows:
            parts.append(row_violations(name, df, rule.key, rule.rows))
        if rule.primary:
            parts.append(primary_key_violations(name, df, rule.key))
        for u in rule.unique:
            parts.append(unique_violations(name, df, u.columns))
        for f in rule.foreign:
            if f.parent in tables:
                parts.append(foreign_key_violations(name, df, f.columns, tables[f.parent], f.parent_columns, f.parent))
    return reduce(lambda a, b: a.unionByName(b), parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows (UNION of one-row counts)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.union(b), counts)
