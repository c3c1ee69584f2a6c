"""Text expressions whose results follow PostgreSQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The audience text for each film rating.
AUDIENCE_BY_RATING = {
    "G": "All ages",
    "PG": "Parental Guidance Suggested",
    "PG-13": "Inappropriate for Children Under 13",
    "R": "Children Under 17 Require Accompanying Adult",
    "NC-17": "Inappropriate for Children Under 17",
}

# The picture for report amounts, and its width with the sign slot.
AMOUNT_PICTURE = "999,999,990.00"
AMOUNT_WIDTH = 15

# The units of sizes.
SIZE_UNITS = ["bytes", "kB", "MB", "GB", "TB", "PB"]


def join_skipping_nulls(*parts: Column) -> Column:
    """``CONCAT``: a NULL part counts as empty text."""
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def join_or_null(*parts: Column) -> Column:
    """``a || b``: NULL as soon as one part is NULL."""
    return F.concat(*parts)


def same_text(left: Column, right: Column | str) -> Column:
    """Equality without case; accents still count."""
    other = F.upper(F.lit(right)) if isinstance(right, str) else F.upper(right)
    return F.upper(left) == other


def in_texts(column: Column, values: Sequence[str]) -> Column:
    """Membership without case."""
    return F.upper(column).isin([v.upper() for v in values])


def label_for(column: Column, labels: Mapping[str, str], default: str) -> Column:
    """Look a code up in a small fixed list, without case."""
    result = F.lit(default)
    for code, label in labels.items():
        result = F.when(same_text(column, code), F.lit(label)).otherwise(result)
    return result


def percent_text(column: Column, digits: int = 4) -> Column:
    """``12.3400 %``."""
    return F.concat(column.cast(f"decimal(20,{digits})").cast("string"), F.lit(" %"))


def amount_text(column: Column) -> Column:
    """An amount with thousands separators, right-aligned to fifteen characters.

    A minus sign stands directly before the first digit; an amount that does not
    fit the picture prints as ``#`` signs.
    """
    amount = F.round(column, 2).cast("decimal(38,2)")
    fits = F.abs(amount) < F.lit("1000000000.00").cast("decimal(38,2)")
    digits = F.to_char(F.when(fits, F.abs(amount)).cast("decimal(11,2)"), F.lit(AMOUNT_PICTURE))
    signed = F.concat(F.when(amount < 0, F.lit("-")).otherwise(F.lit("")), F.ltrim(digits))
    overflow = F.concat(F.when(amount < 0, F.lit("-")).otherwise(F.lit(" ")), F.lit("###,###,###.##"))
    return F.when(fits, F.lpad(signed, AMOUNT_WIDTH, " ")).when(~fits, overflow)


def size_text(column: Column, largest: str = "PB") -> Column:
    """Bytes in the first unit that keeps the figure below 10240, rounded half up; in the ``largest`` if none does.

    Shifts keep the arithmetic in integers: a decimal quotient rounded twice can be
    one off. What a ``bigint`` does not hold may have 38 digits, and is in the largest unit.
    """
    units = SIZE_UNITS[: SIZE_UNITS.index(largest) + 1]
    n = F.abs(column.cast("bigint"))
    sign = F.when(column < 0, F.lit("-")).otherwise(F.lit(""))
    result = F.lit(None).cast("string")
    for step, unit in reversed(list(enumerate(units))):
        figure = n if step == 0 else F.shiftright(F.shiftright(n, 10 * step - 1) + 1, 1)
        shown = F.concat(sign, figure.cast("string"), F.lit(f" {unit}"))
        result = shown if unit == units[-1] else F.when(figure < 10240, shown).otherwise(result)
    whole = F.abs(column.cast("decimal(38,0)"))
    size = F.lit(1 << 10 * (len(units) - 1)).cast("decimal(16,0)")
    # Without its rest the number is a multiple of the unit, so the quotient is exact.
    rest = whole % size
    beyond = ((whole - rest) / size).cast("decimal(38,0)") + F.when(rest * 2 >= size, 1).otherwise(0)
    beyond = F.concat(sign, beyond.cast("string"), F.lit(f" {units[-1]}"))
    return F.when(whole > F.lit(2**63 - 1), beyond).when(column.isNotNull(), result)


def message(template: str, *arguments: Column) -> Column:
    return F.format_string(template, *arguments)


def list_text(array: Column, separator: str = ", ") -> Column:
    return F.array_join(array, separator)


def number_after_prefix(column: Column, prefix: str) -> Column:
    """The number behind a fixed label, NULL when the rest is not a number."""
    return F.replace(column, F.lit(prefix), F.lit("")).try_cast("bigint")
