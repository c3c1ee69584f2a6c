"""Sales reports over a star schema.

``SalesStar.lines`` joins the fact table to just the dimensions a report needs.
Every report takes such joined lines, so it also runs over any other table that
has the columns. Dimensions carry no broadcast hint: Spark broadcasts one when
its size allows and otherwise merges, with AQE splitting a hot key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions.numbers import add_cells, percent_of, total
from ledgerline.functions.text import amount_text, percent_text
from ledgerline.operators import pivot, windows
from ledgerline.operators.ordering import ascending, top_n_per_group, top_rank_per_group


@dataclass(frozen=True)
class SalesStar:
    """Fact and dimensions. ``times`` is optional: without it the calendar comes from the date."""

    sales: DataFrame
    customers: DataFrame | None = None
    countries: DataFrame | None = None
    channels: DataFrame | None = None
    products: DataFrame | None = None
    times: DataFrame | None = None

    def lines(self, *columns: str) -> DataFrame:
        """Sales lines with ``columns`` and ``time_id``, ``amount_sold``."""
        wanted = set(columns)
        result = self.sales
        if wanted & {"cust_first_name", "cust_last_name", "country_region"}:
            result = result.join(self.customers, "cust_id", "inner")
        if "country_region" in wanted:
            result = result.join(self.countries, "country_id", "inner")
        if "channel_desc" in wanted:
            result = result.join(self.channels, "channel_id", "inner")
        if wanted & {"prod_name", "prod_category"}:
            result = result.join(self.products, "prod_id", "inner")
        calendar: list[str] = []
        if self.times is not None:
            calendar = [c for c in self.times.columns if c != "time_id"]
            result = result.join(self.times, "time_id", "inner")
        return result.select("time_id", "amount_sold", *columns, *calendar)


_DERIVED = {
    "calendar_year": F.year,
    "calendar_quarter_number": F.quarter,
    "calendar_month_desc": cal.month_text,
    "calendar_week_number": F.weekofyear,
    "day_name": cal.day_name,
}


def _attribute(lines: DataFrame, name: str) -> Column:
    return F.col(name) if name in lines.columns else _DERIVED[name](F.col("time_id"))


def _in_years(lines: DataFrame, first: int, last: int) -> Column:
    if "calendar_year" in lines.columns:
        return F.col("calendar_year").between(first, last)
    return cal.in_years(F.col("time_id"), first, last)


def _in_weeks(lines: DataFrame, year: int, first: int, last: int) -> Column:
    if "calendar_week_number" in lines.columns:
        return (F.col("calendar_year") == year) & F.col("calendar_week_number").between(first, last)
    return cal.in_iso_weeks(F.col("time_id"), year, first, last)


def _in_months(lines: DataFrame, months: Sequence[str]) -> Column:
    exact = _attribute(lines, "calendar_month_desc").isin(list(months))
    if "calendar_month_desc" in lines.columns:
        return exact
    firsts = sorted(dt.date.fromisoformat(f"{m}-01") for m in months)
    end = (firsts[-1] + dt.timedelta(days=32)).replace(day=1)
    return cal.in_range(F.col("time_id"), firsts[0], end) & exact


def _day(lines: DataFrame) -> Column:
    return F.to_date("time_id").alias("time_id")


def channel_share(
    lines: DataFrame,
    first_year: int = 1999,
    last_year: int = 2001,
    regions: Sequence[str] = ("Americas", "Asia", "Europe"),
) -> DataFrame:
    """Share of each channel in its region and year, the share a row earlier, and the difference.

    The first listed year has no earlier row, so its previous share is 0.
    """
    sold = (
        lines.filter(_in_years(lines, first_year, last_year) & F.col("country_region").isin(list(regions)))
        .groupBy("country_region", _attribute(lines, "calendar_year").alias("calendar_year"), "channel_desc")
        .agg(total(F.col("amount_sold")).alias("amount_sold"))
    )
    whole = windows.partition_total("amount_sold", ["country_region", "calendar_year"])
    shares = sold.withColumn("pct_by_channels", percent_of(F.col("amount_sold"), whole, 2))
    previous = windows.previous_or_zero("pct_by_channels", ["country_region", "channel_desc"], ["calendar_year"])
    return (
        shares.withColumn("pct_previous_period", previous)
        .withColumn("pct_diff", F.round(F.col("pct_by_channels") - F.col("pct_previous_period"), 2))
        .orderBy(*ascending("country_region", "calendar_year", "channel_desc"))
    )


def daily_sales(lines: DataFrame, condition: Column | None = None, marks: Sequence[str] = ()) -> DataFrame:
    """One row per day: ``time_id, calendar_week_number, day_name, sales``, and ``marks``, which the day decides."""
    kept = lines if condition is None else lines.filter(condition)
    return kept.groupBy(
        _day(lines),
        _attribute(lines, "calendar_week_number").alias("calendar_week_number"),
        _attribute(lines, "day_name").alias("day_name"),
        *marks,
    ).agg(total(F.col("amount_sold")).alias("sales"))


def weekly_sales_report(
    lines: DataFrame,
    year: int = 1999,
    first_week: int = 49,
    last_week: int = 51,
    reset_each_week: bool = False,
    neighbours_outside: bool = False,
) -> DataFrame:
    """Daily sales with a running sum and a weekday-aware centred average.

    By default the sum runs over all the weeks and the first and last day miss
    their neighbours outside them. ``reset_each_week`` starts the sum every Monday;
    ``neighbours_outside`` reads the days around the weeks before it cuts them off.
    """
    weeks = _in_weeks(lines, year, first_week, last_week)
    columns = ["calendar_week_number", "time_id", "day_name", "sales"]
    average = windows.weekday_centered_average("sales", "time_id", "day_name")
    if neighbours_outside:
        # The nearest day with sales may be any time ago, so all days are averaged, one row each, before the cut.
        marked = daily_sales(lines.withColumn("__fits", weeks), marks=["__fits"])
        days = marked.withColumn("centered_3_day_avg", average).filter("__fits")
    else:
        days = daily_sales(lines, weeks).withColumn("centered_3_day_avg", average)
    by = ["calendar_week_number"] if reset_each_week else []
    summed = windows.daily_running_total(days, "sales", "time_id", "cum_sum", by)
    return summed.select(*columns, "cum_sum", "centered_3_day_avg").orderBy(*ascending("time_id"))


def running_total_rows(lines: DataFrame, year: int = 1999, week: int = 49) -> DataFrame:
    days = daily_sales(lines, _in_weeks(lines, year, week, week)).withColumnRenamed("sales", "daily_sales")
    result = windows.daily_running_total(days, "daily_sales", "time_id", "running_total_rows")
    return result.drop("calendar_week_number").orderBy(*ascending("time_id"))


def running_total_range(lines: DataFrame, year: int = 1999, week: int = 49) -> DataFrame:
    days = daily_sales(lines, _in_weeks(lines, year, week, week)).withColumnRenamed("sales", "daily_sales")
    result = windows.daily_range_total(days, "daily_sales", "time_id", "running_total_range")
    return result.drop("calendar_week_number").orderBy(*ascending("time_id"))


def running_total_groups(lines: DataFrame, year: int = 1999, week: int = 49) -> DataFrame:
    """The frame follows the amount, not the date: days with equal sales count together."""
    days = daily_sales(lines, _in_weeks(lines, year, week, week)).withColumnRenamed("sales", "daily_sales")
    result = windows.groups_frame(days, F.col("daily_sales"), "daily_sales", "running_group_total")
    return result.drop("calendar_week_number").orderBy(*ascending("daily_sales", "time_id"))


def top_customers_per_channel(lines: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` best customers of each channel with their share of the channel as text.

    Customers are told apart by name. The channel total is its own aggregate and
    joins the few top rows; a window for it would send each whole channel to one
    task.
    """
    names = ["channel_desc", "cust_last_name", "cust_first_name"]
    sold = lines.groupBy(*names).agg(total(F.col("amount_sold")).alias("amount_sold"))
    channel = sold.groupBy("channel_desc").agg(F.sum("amount_sold").alias("total_channel_sales"))
    order = [F.col("amount_sold").desc_nulls_first(), *ascending("cust_last_name", "cust_first_name")]
    best = top_n_per_group(sold, ["channel_desc"], order, n)
    share = percent_text(percent_of(F.col("amount_sold"), F.col("total_channel_sales"), 4), 4)
    return (
        best.join(channel, "channel_desc", "inner")
        .withColumn("sales_percentage", share)
        .select(*names, "amount_sold", "sales_percentage")
        .orderBy(F.col("channel_desc").asc_nulls_last(), *order)
    )


def product_quarter_pivot(
    lines: DataFrame, category: str = "Photo", region: str = "Asia", year: int = 2000
) -> DataFrame:
    """Products by quarter with the row total; a quarter without sales is NULL."""
    kept = lines.filter(
        (F.col("prod_category") == category) & (F.col("country_region") == region) & _in_years(lines, year, year)
    ).withColumn("__quarter", _attribute(lines, "calendar_quarter_number"))
    cells = {1: "q1", 2: "q2", 3: "q3", 4: "q4"}
    wide = pivot.crosstab(kept, ["prod_name"], "__quarter", cells, total(F.col("amount_sold")))
    row_total = F.round(add_cells(*[F.col(c) for c in cells.values()]), 2)
    return (
        wide.withColumnRenamed("prod_name", "product_name")
        .withColumn("year_sum", row_total)
        .orderBy(F.col("year_sum").desc_nulls_first(), *ascending("product_name"))
    )


def yearly_top_customers(
    lines: DataFrame,
    years: Sequence[int] = (1998, 1999, 2001),
    limit: int = 300,
    rank_within_channel: bool = False,
    in_every_year: bool = False,
) -> DataFrame:
    """Per channel, what the customers in a yearly top list spent in the years they were in it.

    By default the rank of a year runs over all (channel, customer) totals and one
    such year is enough. ``rank_within_channel`` ranks each channel on its own and
    ``in_every_year`` asks for all the years.
    """
    year = _attribute(lines, "calendar_year")
    wanted = reduce(lambda a, b: a | b, [_in_years(lines, y, y) for y in years])
    who = ["channel_desc", "cust_id", "cust_last_name", "cust_first_name"]
    sold = lines.filter(wanted).groupBy(*who, year.alias("sales_year")).agg(total(F.col("amount_sold")).alias("sold"))
    group = ["sales_year", "channel_desc"] if rank_within_channel else ["sales_year"]
    ranked = top_rank_per_group(sold, group, [F.col("sold").desc_nulls_first()], limit, "sales_rank")
    report = ranked.groupBy(*who).agg(F.sum("sold").alias("amount"), F.count(F.lit(1)).alias("n_years"))
    if in_every_year:
        report = report.filter(F.col("n_years") == len(set(years)))
    # Sorted by the number; the text comes last.
    return report.orderBy(
        F.col("channel_desc").asc_nulls_last(), F.col("amount").desc_nulls_first(), F.col("cust_id").asc_nulls_last()
    ).select(*who, amount_text(F.col("amount")).alias("amount_sold"))


def month_category_report(
    lines: DataFrame,
    months: Sequence[str] = ("2000-01", "2000-02", "2000-03"),
    regions: Mapping[str, str] | None = None,
) -> DataFrame:
    """Month by product category, one sales column per region; no sales is 0."""
    cells = regions or {"Americas": "Americas SALES", "Europe": "Europe SALES"}
    kept = lines.filter(_in_months(lines, months) & F.col("country_region").isin(list(cells))).withColumn(
        "calendar_month_desc", _attribute(lines, "calendar_month_desc")
    )
    keys = ["calendar_month_desc", "prod_category"]
    wide = pivot.conditional_sums(kept, keys, "country_region", cells, F.col("amount_sold").cast("decimal(18,2)"))
    return wide.orderBy(*ascending(*keys))
