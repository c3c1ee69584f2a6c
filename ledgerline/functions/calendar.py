"""Calendar attributes and date windows.

Year, quarter and week predicates are written as half-open ranges on the raw
column, so the parquet scan receives both bounds; ``year(c) = y`` pushes only
``IsNotNull``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_range(column: Column, start: dt.date, end: dt.date) -> Column:
    """``start <= column < end``."""
    return (column >= F.lit(start)) & (column < F.lit(end))


def in_years(column: Column, first: int, last: int) -> Column:
    return in_range(column, dt.date(first, 1, 1), dt.date(last + 1, 1, 1))


def in_iso_weeks(column: Column, year: int, first_week: int, last_week: int) -> Column:
    """Calendar year ``year`` and ISO week between the two, as half-open ranges.

    The first days of a year may belong to week 52 or 53 and the last ones to week 1, so
    the days that fit make up to three runs; a year without them fits no day.
    """
    one = dt.timedelta(days=1)
    runs: list[list[dt.date]] = []
    day = dt.date(year, 1, 1)
    while day.year == year:
        if first_week <= day.isocalendar().week <= last_week:
            if runs and runs[-1][1] == day:
                runs[-1][1] = day + one
            else:
                runs.append([day, day + one])
        day += one
    fits = F.lit(False)
    for start, end in runs:
        fits = fits | in_range(column, start, end) if start != runs[0][0] else in_range(column, start, end)
    return fits


def quarter_bounds(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First day of the quarter that contains ``as_of`` and of the one after it."""
    first_month = 3 * ((as_of.month - 1) // 3) + 1
    start = dt.date(as_of.year, first_month, 1)
    end = dt.date(as_of.year + (first_month == 10), (first_month + 3 - 1) % 12 + 1, 1)
    return start, end


def previous_quarter_bounds(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """The last complete calendar quarter before ``as_of``."""
    this_start, _ = quarter_bounds(as_of)
    return quarter_bounds(this_start - dt.timedelta(days=1))


def day_name(column: Column) -> Column:
    return F.date_format(column, "EEEE")


def month_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM")


def with_calendar(df: DataFrame, time_column: str = "time_id") -> DataFrame:
    """Add the attributes a ``times`` dimension would carry, derived from the date itself."""
    c = F.col(time_column)
    return df.withColumns(
        {
            "calendar_year": F.year(c),
            "calendar_quarter_number": F.quarter(c),
            "calendar_month_desc": month_text(c),
            "calendar_week_number": F.weekofyear(c),
            "day_name": day_name(c),
        }
    )


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days, as an integer (Spark's ``-`` on dates gives an interval)."""
    return F.datediff(later, earlier)


def as_of_or_today(as_of: dt.date | None) -> dt.date:
    """Reports take the date they speak about; only an absent one means today."""
    return as_of if as_of is not None else dt.date.today()
