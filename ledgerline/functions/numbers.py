"""Exact money arithmetic. Amounts become decimals before they are summed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# Wide enough for the grand total of a very large fact table, narrow enough that
# a quotient of two such totals keeps twelve fractional digits.
TOTAL = "decimal(22,2)"


def money(column: Column) -> Column:
    return column.cast(MONEY)


def total(column: Column) -> Column:
    """Exact sum of a money column."""
    return F.sum(money(column)).cast(TOTAL)


def percent_of(part: Column, whole: Column, digits: int) -> Column:
    """``round(100 * part / whole, digits)`` in decimal arithmetic, half up."""
    return F.round(F.lit(100) * part.cast(TOTAL) / whole.cast(TOTAL), digits)


def add_cells(*cells: Column) -> Column:
    """Row total across pivot cells; a missing cell counts as zero."""
    result = F.coalesce(cells[0], F.lit(0))
    for cell in cells[1:]:
        result = result + F.coalesce(cell, F.lit(0))
    return result


def power(base: Column, exponent: Column) -> Column:
    """``a ^ b`` as a power; in Spark SQL ``^`` is exclusive or."""
    return F.pow(base, exponent)
